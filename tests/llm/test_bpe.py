import gc
import random
import weakref

import numpy as np
import pytest
from conftest import VOCABULARIES
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm.bpe import BacktrackingBpe, OffsetTable, decode, encode, read_definition
from millrace.llm.common import in_small_batches, slices

PATH = f"{VOCABULARIES}/byte_bpe_50k.json"
LIBRARY = Tokenizer.from_file(PATH)
OWN = BacktrackingBpe(read_definition(PATH))
TABLE = OffsetTable(read_definition(PATH))


def ids_of(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def agree(text):
    ids = np.frombuffer(OWN.encode(text), dtype="<u4").tolist()
    assert ids == ids_of(text)
    assert TABLE.decode(OWN.encode(text)) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    agree(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["the", "re", "'s", " ", "  ", "\n", "in", "g", "<|endoftext|>", "é", "😀", "\x1c", "\x85", "a", "2", "½", "　"]), max_size=40))
def test_pieces(parts):
    agree("".join(parts))


@pytest.mark.parametrize("text", ["a" * 40_000, "ab" * 20_000, " " * 20_000, "<|endoftext|>" * 500, "the" * 5_000])
def test_long_runs(text):
    agree(text)


def test_words_of_random_letters():
    rng = random.Random(1)
    for _ in range(300):
        agree(" ".join("".join(rng.choice("etaoinshrdlucm") for _ in range(rng.randrange(1, 14))) for _ in range(20)))


def test_decoding_ids_that_are_no_text():
    ids = np.array([50256, 50257, 2**31, 126, 223, 0], dtype="<u4")
    known = [i for i in ids.tolist() if i < 50257]
    assert TABLE.decode(ids.tobytes()) == LIBRARY.decode(known, skip_special_tokens=False)
    assert TABLE.decode(b"") == ""


def test_frames(documents):
    rows = [(1, "hello world"), (1, "hello world"), (None, "x"), (2, None), (3, "")]
    encoded = encode(documents(*rows, clashing=True), PATH, keep=("source", "key"))
    assert encoded.columns == ["doc_id", "source", "key", "ids"]
    got = decode(encoded, PATH, "source").collect()
    assert sorted((str(r.doc_id), r.text, r.source) for r in got) == sorted((str(i), t or "", "s") for i, t in rows)
    assert encode(documents(), PATH).collect() == []
    assert decode(encode(documents(), PATH), PATH).collect() == []


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="plain byte-level"):
        BacktrackingBpe(read_definition(f"{VOCABULARIES}/word_bpe_49k.json"))


def test_workers_let_go_of_the_tables(spark, documents):
    """Once a worker has a task of another operator, the tables are gone from its memory."""
    rows = documents(*[(i, f"text {i}") for i in range(64)]).repartition(8)
    assert encode(rows, PATH, decoded="back").where("back = concat('text ', doc_id)").count() == 64

    def alive(batches):
        import pyarrow as pa

        for batch in slices(batches):
            # By name, as the worker's class and the one this function brings along may differ.
            kinds = [type(x).__name__ for x in gc.get_objects()]
            found = sum(kind in ("BacktrackingBpe", "Automaton") for kind in kinds)
            yield pa.RecordBatch.from_arrays([pa.array([found] * batch.num_rows, pa.int64())], ["found"])

    assert {r.found for r in rows.select("doc_id").mapInArrow(alive, "found bigint").collect()} == {0}


def test_tables_are_freed_without_the_garbage_collector():
    gc.disable()
    try:
        own = BacktrackingBpe(read_definition(PATH))
        gone, n_bytes = weakref.ref(own), len(own.encode("some words"))
        del own
        assert n_bytes > 0
        assert gone() is None
    finally:
        gc.enable()


def test_workers_get_small_batches(spark):
    texts = spark.range(0, 8_000, 1, 1).selectExpr("id", "repeat('text ', 200) AS text")  # 8 MB in one task

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64()), pa.array([batch.num_rows], pa.int64())], ["size", "n"])

    found = in_small_batches(texts).mapInArrow(sizes, "size bigint, n bigint").collect()
    assert sum(r.n for r in found) == 8_000
    assert max(r.size for r in found) < 1_200_000
