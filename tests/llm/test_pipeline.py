"""The stages against plain versions, each on its own input."""

import hashlib
import random
import re
from pathlib import Path

import numpy as np
import pytest
from conftest import VOCABULARIES, own_columns_are_kept
from test_jaccard import plain as plain_components
from test_mixing import plain_targets
from test_pii import plain as plain_spans
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, documents, tmp_path_factory):
    """Good and bad documents, near copies, personal data, two sources; and the folder with their tables."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9)))
    rows, labels = [], []
    for i in range(700):
        words = [word() for _ in range(rng.randrange(30, 90))]
        if i % 7 == 0:
            words = [w + "###" for w in words]
        labels.append((i, int(i % 7 != 0), 0))
        if i % 10 == 3:
            words = rows[i - 2][1].split()[:-1] + ["changed"]
            labels[-1] = (i, labels[i - 2][1], 0)
        if i % 11 == 0:
            words.insert(5, "mail x@y.example.com")
        rows.append((i, " ".join(words), "a" if i % 3 else "b"))
    folder = tmp_path_factory.mktemp("tables")
    documents(*rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows, labels, str(folder)


def test_stages_and_registration():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "personal_data", "mixing", "tokens"]
    assert contract.queries()["pipeline"] is corpus_pipeline.run


def stage(number, spark, docs, folder):
    return corpus_pipeline.STAGES[number][1](spark, docs, folder)


def test_quality_drops_the_rejected(spark, corpus, documents):
    rows, labels, folder = corpus
    kept = stage(0, spark, documents(*rows), folder)
    assert kept.columns == COLUMNS
    assert {r.doc_id for r in kept.collect()} == {i for i, good, _ in labels if good}


def test_near_copies_leave_one(spark, corpus, documents):
    rows, _, folder = corpus
    kept = stage(1, spark, documents(*rows), folder)
    assert kept.columns == COLUMNS
    components = plain_components([row[:2] for row in rows], 80, 5)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _, lowest in components if lowest == i)


def test_personal_data_goes(spark, corpus, documents):
    rows, _, folder = corpus
    cleaned = stage(2, spark, documents(*rows), folder)
    assert cleaned.columns == COLUMNS
    got = {r.doc_id: r for r in cleaned.collect()}
    for i, text, _ in rows:
        want = text.replace("x@y.example.com", "[email]")
        assert (got[i].text, got[i].n_chars) == (want, len(want))
        assert plain_spans(got[i].text) == []


def test_mixing_repeats_whole_rows(spark, corpus, documents):
    rows, _, folder = corpus
    mixed = stage(3, spark, documents(*rows), folder)
    assert mixed.columns == COLUMNS
    words = {name: sum(len(t.split()) for _, t, s in rows if s == name) for name in "ab"}
    taken = {name: sum(len(r.text.split()) for r in mixed.collect() if r.source == name) for name in "ab"}
    total = sum(words.values())
    assert abs(taken["a"] - total / 3) < 0.1 * total
    assert abs(taken["b"] - total * 2 / 3) < 0.1 * total


def test_tokens_are_the_librarys(spark, corpus, documents):
    rows, _, folder = corpus
    library = Tokenizer.from_file(f"{VOCABULARIES}/byte_bpe_50k.json")
    got = {r.doc_id: r for r in stage(4, spark, documents(*rows), folder).collect()}
    for i, text, _ in rows[:200]:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(got[i].ids, dtype="<u4").tolist() == want
        assert (got[i].n_tokens, got[i].round_trip) == (len(want), True)


def plain_mix(rows):
    """Every document as often as the mix takes it: by its source's rate and its own draw."""
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    targets = plain_targets(sizes)
    taken = []
    for i, text, source in rows:
        rate = targets[source] / sizes[source]
        draw = int(hashlib.md5(f"mix-1:{i}".encode()).hexdigest()[:13], 16) / 16.0**13
        taken += [(i, text, source)] * (int(rate) + (draw < rate - int(rate)))
    return taken


def test_all_stages_in_a_row_equal_plain_ones(spark, corpus, documents):
    """What the classifier keeps, which is learned, then plain versions of all other stages."""
    rows, _, folder = corpus
    good = {r.doc_id for r in stage(0, spark, documents(*rows), folder).collect()}
    kept = [row for row in rows if row[0] in good]
    kept = [row for row, (_, _, lowest) in zip(kept, sorted(plain_components([r[:2] for r in kept], 80, 5))) if lowest == row[0]]
    clean = [(i, text.replace("x@y.example.com", "[email]"), source) for i, text, source in kept]
    library = Tokenizer.from_file(f"{VOCABULARIES}/byte_bpe_50k.json")
    want = [(i, source, library.encode(text, add_special_tokens=False).ids) for i, text, source in plain_mix(clean)]
    result = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id, r.source, np.frombuffer(r.ids, dtype="<u4").tolist()) for r in result) == sorted(want)
    assert all(r.round_trip and r.n_tokens == len(r.ids) // 4 for r in result)


def test_defined_cases(spark, corpus, documents):
    _, _, folder = corpus
    odd = documents((None, "a b"), (1, None), (2, ""), (3, "w " * 30_000), (4, "x y"), (4, "x y"), clashing=True)
    for number in range(4):
        result = stage(number, spark, odd, folder)
        assert result.columns == odd.columns
        assert own_columns_are_kept(result)
        assert stage(number, spark, documents(), folder).collect() == []
    assert stage(4, spark, odd, folder).count() == 6
    assert stage(4, spark, documents(), folder).collect() == []


def test_the_library_does_not_know_the_subpackage():
    root = Path(corpus_pipeline.__file__).parent / "millrace"
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"\bllm\b", path.read_text()), path
