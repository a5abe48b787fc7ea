import random
import zlib

import numpy as np
import pandas as pd
import pytest
from conftest import VOCABULARIES
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import shards
from millrace.llm.bpe import read_definition
from millrace.sources import staging_path

PATH = f"{VOCABULARIES}/word_bpe_49k.json"
LIBRARY = Tokenizer.from_file(PATH)
OWN = shards.WordEncoder(read_definition(PATH))
END = 1


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=50), st.text(alphabet="aBÀéßŐſŉıİΣς'sd1 ,.\n\t\x1c\x85中é😀ĸ<|>", max_size=40)))
def test_words_encode_as_whole_texts(text):
    assert OWN.by_word
    assert np.frombuffer(OWN.encode(text), dtype="<u2").tolist() == ids_of(text)


@pytest.mark.parametrize("text", ["a<|endoftext|>b", " <|startoftext|>", "It's Don'T I'll", "x" * 30_000, "<|ENDOFTEXT|>"])
def test_special_words(text):
    assert np.frombuffer(OWN.encode(text), dtype="<u2").tolist() == ids_of(text)


def test_other_tokenizers_encode_whole_texts():
    other = shards.WordEncoder(read_definition(f"{VOCABULARIES}/byte_bpe_50k.json"))
    library = Tokenizer.from_file(f"{VOCABULARIES}/byte_bpe_50k.json")
    assert not other.by_word
    text = "two  words\n<|endoftext|>"
    assert np.frombuffer(other.encode(text), dtype="<u2").tolist() == library.encode(text, add_special_tokens=False).ids


def written(spark, df, **options):
    folder = staging_path(spark, "test-shards")
    shards.write_shards(df, folder, PATH, END, **options)
    keys = spark.read.parquet(f"{folder}/entries").select("doc_id", "copy")
    return folder, shards.read_ids(shards.find(keys, folder), folder, PATH)


def test_round_trip_through_many_shards(spark, documents):
    rng = random.Random(8)
    rows = [(i * 3, " ".join(rng.choice(["the", "cat", "Über", "12"]) for _ in range(rng.randrange(30)))) for i in range(500)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    folder, read = written(spark, documents(*shuffled, clashing=True), shard_bytes=2_000)
    assert spark.read.parquet(f"{folder}/manifest").count() > 5
    start = 0
    got = {row.doc_id: row for row in read.collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        ids = [*ids_of(text), END]
        row = got[doc_id]
        assert np.frombuffer(row.ids, dtype="<u4").tolist() == ids
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)


def test_defined_cases(spark, documents):
    rows = [(5, "b"), (None, "n"), (5, "a"), (5, "a"), (1, None), (2, ""), (None, None)]
    _, read = written(spark, documents(*rows))
    got = [(r.doc_id, np.frombuffer(r.ids, dtype="<u4").tolist()) for r in read.orderBy("start").collect()]
    ordered = [(None, ""), (None, "n"), (1, ""), (2, ""), (5, "a"), (5, "a"), (5, "b")]
    assert got == [(i, [*ids_of(t), END]) for i, t in ordered]
    folder, read = written(spark, documents())
    assert read.collect() == []
    assert spark.read.parquet(f"{folder}/index").count() == 0


def test_unknown_keys_are_not_found(spark, documents):
    folder, _ = written(spark, documents(*[(i, f"t {i}") for i in range(200)]))
    keys = spark.range(100, 5000).select(F.col("id").alias("doc_id"), F.lit(0).cast("bigint").alias("copy"))
    assert sorted(r.doc_id for r in shards.find(keys.unionByName(keys), folder).collect()) == list(range(100, 200))


@pytest.mark.parametrize("n", [1, 2, 17, 5000])
def test_hash_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    rows = pd.DataFrame(
        {
            "first": rng.integers(-(2**63), 2**63 - 1, n), "second": rng.integers(-(2**63), 2**63 - 1, n), "bucket": 0,
            "shard": [f"s{i % 3}" for i in range(n)], "place": np.arange(n), "n_tokens": np.arange(n) + 1,
        }
    )
    index = shards.build_bucket(rows)
    assert len(index["fingerprints"][0]) == 4 * n  # a slot per key, none free
    found = shards.look_up(rows[["first", "second", "bucket"]].assign(row=np.arange(n)), index)
    assert (found["place"].to_numpy() == np.arange(n)).all()
    assert (found["n_tokens"].to_numpy() == np.arange(n) + 1).all()
    assert found["shard"].tolist() == rows["shard"].tolist()
    bits = sum(index["level_sizes"][0])
    assert n < 100 or bits < 6 * n


def test_equal_hashes_are_reported():
    rows = pd.DataFrame({"first": [1, 1], "second": [2, 2], "bucket": 0, "shard": "s", "place": [0, 1], "n_tokens": 1})
    with pytest.raises(ValueError, match="equal hashes"):
        shards.build_bucket(rows)


def test_rows_of_one_id_fill_several_shards(spark, documents):
    """An id, and no id, in a third of the rows each: shards stay even, copies are numbered through."""
    rng = random.Random(3)
    word = lambda: " ".join(rng.choice(["the", "cat", "sat", "on"]) for _ in range(12))
    rows = [(i, word()) for i in range(300)] + [(150, word()) for _ in range(150)] + [(150, "same " * 10)] * 150 + [(None, word()) for _ in range(300)]
    folder, read = written(spark, documents(*rows), shard_bytes=4_000)
    sizes = [r["count"] for r in spark.read.parquet(f"{folder}/entries").groupBy("shard").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 300
    got = [(r.doc_id, r.copy, np.frombuffer(r.ids, dtype="<u4").tolist()) for r in read.orderBy("start").collect()]
    assert [i for i, _, _ in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    for key in (None, 150):
        assert [copy for i, copy, _ in got if i == key] == list(range(sum(i == key for i, _ in rows)))
    wanted = sorted((str(i), [*ids_of(t), END]) for i, t in rows)
    assert sorted((str(i), ids) for i, _, ids in got) == wanted


def test_few_tasks_open_a_shard(spark, documents, monkeypatch):
    rows = [(i, "the cat sat " * 8) for i in range(600)]
    folder, read = written(spark, documents(*rows), shard_bytes=10_000)
    shards_ = spark.read.parquet(f"{folder}/manifest").count()
    opened = read.select("shard", F.spark_partition_id().alias("task")).distinct().count()
    assert opened == shards_ > 4
    monkeypatch.setattr(shards, "STRETCH_IDS", 1_000)
    keys = spark.read.parquet(f"{folder}/entries").select("doc_id", "copy")
    again = shards.read_ids(shards.find(keys, folder), folder, PATH)
    opened = again.select("shard", F.spark_partition_id().alias("task")).distinct().count()
    assert shards_ < opened <= shards_ + 600 * 25 // 1_000 + shards_
    assert sorted(again.select("doc_id", "ids_crc32").collect()) == sorted(read.select("doc_id", "ids_crc32").collect())


def test_empty_buckets_do_not_move_keys(spark, documents, monkeypatch):
    monkeypatch.setattr(shards, "KEYS_PER_BUCKET", 1)
    folder, read = written(spark, documents(*[(i, f"t {i}") for i in range(50)]))
    assert spark.read.parquet(f"{folder}/index").count() < 50
    assert sorted(r.doc_id for r in read.collect()) == list(range(50))


def test_folders_are_those_that_spark_means(spark, documents, tmp_path):
    assert shards._qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert shards._open(f"file:{tmp_path}")[1] == str(tmp_path)
    with pytest.raises(ValueError, match="cannot be written"):
        spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.m.link./x", f"file://{tmp_path}")
        shards.write_shards(documents("a"), "viewfs://m/x", PATH, END)


def test_long_pieces_are_not_kept():
    cache = shards.BoundedCache(len, 2)
    assert [cache[key] for key in ("a", "b" * 65, "bc", "d", "bc")] == [1, 65, 2, 1, 2]
    assert list(cache) == ["a", "bc"]
