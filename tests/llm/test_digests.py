"""Every contract column of the registered queries that have no SQL, against plain Python, on a small folder of tables."""

import hashlib
import random
import struct
import zlib

import pytest
from conftest import VOCABULARIES
from test_exact import plain as plain_groups
from test_periods import plain as plain_runs
from test_pii import FORMS
from test_pii import plain as plain_spans
from test_rules import plain as plain_statistics
from tokenizers import Tokenizer

from millrace.llm.queries import QUERIES


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.fixture(scope="module")
def tables(spark, documents, tmp_path_factory):
    rng = random.Random(31)
    word = lambda: "".join(rng.choice("etaoinshrdlué") for _ in range(rng.randrange(1, 9)))
    odd = ["a@b.c", "+1 (234) 567-8901", "4111 1111 1111 1111", "10.0.0.1", "256.1.1.1", "IDIOT!", "##", "😀", "\n", "\t", "don't", "<|endoftext|>"]
    texts = [" ".join(rng.choice(odd) if rng.random() < 0.1 else word() for _ in range(rng.randrange(1, 120))) for _ in range(160)]
    texts += ["same line\n" * 9, "go " * 40, "x", "", " ", None, texts[3], texts[3], "w1 w2 w3 " * 700]
    rows = list(enumerate(texts))
    folder = str(tmp_path_factory.mktemp("digests"))
    documents(*rows).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(rng.random() < 0.8), int("IDIOT" in (t or ""))) for i, t in rows if i % 3]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows


def results(spark, tables, key):
    folder, rows = tables
    got = {r.doc_id: r for r in QUERIES[key](spark, folder).collect()}
    assert sorted(got) == [i for i, _ in rows]
    return got, rows


def test_token_shards(spark, tables):
    got, rows = results(spark, tables, "op1_token_shards")
    library, start = Tokenizer.from_file(f"{VOCABULARIES}/word_bpe_49k.json"), 0
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        r = got[i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)


def test_quality_rules(spark, tables):
    got, rows = results(spark, tables, "op2_quality_rules")
    for i, text in rows:
        n, *others = plain_statistics(text)
        r = got[i]
        failed = n < 20 or 100 * others[3] > 30 * n
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (n, *others, failed)
        assert not (failed and r.kept)


def test_personal_data(spark, tables):
    got, rows = results(spark, tables, "op4_pii")
    for i, text in rows:
        base, r = plain_spans(text), got[i]
        assert [r[f"n_{kind}"] for kind in FORMS] == [sum(s.startswith(f"{kind}:") for s in base) for kind in FORMS]
        assert r.base_sha256 == sha(",".join(base))
        assert set(base) <= set(filter(None, r.spans.split(",")))


def test_byte_bpe(spark, tables):
    got, rows = results(spark, tables, "op6_bpe")
    library = Tokenizer.from_file(f"{VOCABULARIES}/byte_bpe_50k.json")
    library.no_truncation()
    library.no_padding()
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert tuple(got[i])[1:] == (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(decoded))


@pytest.mark.parametrize(("key", "bound"), [("op8_toxicity", 0.5), ("op9_quality_classifier", 0.3)])
def test_predictions(spark, tables, key, bound):
    got, rows = results(spark, tables, key)
    for i, _ in rows:
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= bound)


def test_exact_groups(spark, tables):
    got, rows = results(spark, tables, "op11_exact_dedup")
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got.values()), key=str) == plain_groups(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got.values())


def test_periodic_runs(spark, tables):
    got, rows = results(spark, tables, "op13_periodic_runs")
    for i, text in rows:
        assert tuple(got[i]) == plain_runs(i, text)
