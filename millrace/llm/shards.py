"""Token ids in binary shards, with a minimal perfect hash index from document keys to places.

Layout of a folder in the shared store:

    payload/<name>.ids   raw ids, nothing else; 16 bits each if the vocabulary fits, else 32, little-endian
    entries              Parquet: doc_id, copy, shard, place (ids before it in the shard), n_tokens
    manifest             Parquet: shard, base (ids in all earlier shards)
    index                Parquet: one row per bucket of keys, see `build_bucket`

Documents lie in ascending doc_id order, null first, rows with one id ordered by text (across shards by its first
64 characters); each ends with the end id. A key is the id and the number of its copy (0 unless rows share the id).

A task writes its payload under a name of its own and reports it in its entries; only the entries of
tasks that succeeded are committed, so a lost executor leaves at most files that nothing refers to.

Defined cases: a null text is empty and has the end id alone; repeated rows are copies 0, 1, ...; a null
id is a key like any other; an empty table gives empty tables; other columns are ignored. The folder must be in a
store that tasks can open (see SCHEMES). Two keys of one bucket with equal 128-bit hashes, which MAX_LEVELS levels
cannot tell apart, end in an error.
"""

import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from math import ceil
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.bpe import BoundedCache, byte_alphabet, read_definition
from millrace.llm.common import in_small_batches, slices, whole_text
from millrace.sources import stage

SHARD_BYTES = 128 * 1024 * 1024  # of text, about
START_CHARS = 64  # of a text, by which rows that share an id are dealt
STRETCH_IDS = 16 * 1024 * 1024  # of a shard, read by one task
KEYS_PER_BUCKET = 8_192
BITS_PER_KEY = 2  # of a level of the hash
MAX_LEVELS = 64
CACHED_WORDS = 400_000
CACHED_PIECES = 150_000

ENTRIES = "shard string, place bigint, n_tokens bigint, copy bigint"


# How the vocabularies that drop white space split what is left of a text.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Latin letters that are one code point each in every normal form and in lower case.
_LATIN = "A-Za-z\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u012f\\u0131-\\u0137\\u0139-\\u0148\\u014a-\\u0177\\u0179-\\u017e"


class WordEncoder:
    """Ids of whole texts by the tokenizers library; words are looked up again where that is exact.

    Exact it is for a vocabulary whose splitting drops white space: then no token, normalization or added
    token reaches across a blank. Of those words that are made of Latin letters, digits and ASCII signs,
    whose normal form is their lower case, the pieces go straight to the library's merging model.
    """

    def __init__(self, definition: str):
        spec = json.loads(definition)
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = "<u2" if size <= 1 << 16 else "<u4"
        self.code = "H" if self.dtype == "<u2" else "I"
        self.words = BoundedCache(self._word, CACHED_WORDS)
        self.pieces = BoundedCache(self._piece, CACHED_PIECES)
        normalizer, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens", [])
        self.by_word = (
            [step["type"] for step in normalizer.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and normalizer["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
            and [step["type"] for step in pre.get("pretokenizers", [])] == ["Split", "ByteLevel"]
            and pre["pretokenizers"][0]["pattern"] == {"Regex": _SPLIT}
            and pre["pretokenizers"][0]["invert"]
            and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or " " in a["content"] for a in added)
        )
        self.model = self.tokenizer.model
        self.plain = re.compile(rf"[{_LATIN}!-~]+").fullmatch
        self.split = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN}]+|[0-9]|[^{_LATIN}0-9]+").findall
        self.added = re.compile("|".join(re.escape(a["content"]) for a in added) or "(?!)").search
        self.byte_names = {byte: name for name, byte in byte_alphabet().items()}

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def _ids(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.byte_names)
        return self._packed([token.id for token in self.model.tokenize(spelled)])

    def _word(self, word: str) -> bytes:
        if not self.plain(word) or self.added(word):
            return self._ids(word)
        return b"".join(map(self.pieces.__getitem__, self.split(word.lower())))

    def encode(self, text: str) -> bytes:
        if not self.by_word:
            return self._ids(text)
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=2)
def _encoder(definition: str) -> WordEncoder:
    return WordEncoder(definition)


# Stores that tasks open, by the scheme of a folder's full path, and what they are called there.
SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder's full path, as Spark resolves it: a plain path is one of the default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    scheme = full.split(":", 1)[0]
    if scheme not in SCHEMES:
        raise ValueError(f"payloads cannot be written to {full}; the folder must be in one of {', '.join(SCHEMES)}")
    return full


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    """The store behind a full path."""
    scheme, rest = folder.split(":", 1)
    return fs.FileSystem.from_uri(f"{SCHEMES[scheme]}:{'//' if not rest.startswith('//') else ''}{rest}")


def write_shards(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> None:
    """Encode every text, append the end id, and write payload, entries, manifest and index below `folder`."""
    spark = docs.sparkSession
    folder = _qualified(spark, folder)
    own = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    total = own.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    definition = spark.sparkContext.broadcast(read_definition(vocabulary))
    store, path = _open(folder)
    store.create_dir(f"{path}/payload", recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition.value)
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        width = len(end)
        store, path = _open(folder)
        shard, sink, place, last, copy = uuid4().hex, None, 0, (), 0
        for batch in slices(batches):
            places, sizes, copies = [], [], []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.encode(value) + end
                sink = sink or store.open_output_stream(f"{path}/payload/{shard}.ids")
                sink.write(ids)
                copy = copy + 1 if last == (key,) else 0
                last = (key,)
                places.append(place)
                sizes.append(len(ids) // width)
                copies.append(copy)
                place += len(ids) // width
            long = lambda values: pa.array(values, pa.int64())
            shards = pa.array([shard] * len(places), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), shards, long(places), long(sizes), long(copies)],
                ["doc_id", "shard", "place", "n_tokens", "copy"],
            )
        if sink:
            sink.close()

    # Rows that share an id, or have none, may fill several shards; equal rows are dealt as they come.
    start = F.left("text", F.lit(START_CHARS)).alias("start")
    dealt = own.select("doc_id", "text", start, F.monotonically_increasing_id().alias("row"))
    ranged = dealt.repartitionByRange(max(1, ceil(total / shard_bytes)), "doc_id", "start", "row")
    ordered = ranged.sortWithinPartitions("doc_id", "start", "text").select("doc_id", "text")
    kind = own.schema["doc_id"].dataType.simpleString()
    entries = in_small_batches(ordered).mapInArrow(write, f"doc_id {kind}, {ENTRIES}")
    written = stage(entries.withColumn("task", F.spark_partition_id()), "entries")
    # Copies are counted within a task; the first id of a task may go on from the tasks before, one row a task.
    counted = written.groupBy("task", "doc_id").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("doc_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(F.col("task").alias("t"), F.col("doc_id").alias("d"), F.sum("n").over(earlier).alias("before"))
    goes_on = F.broadcast(offsets.where("before IS NOT NULL"))
    joined = written.join(goes_on, (F.col("task") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d")), "left")
    copies = F.col("copy") + F.coalesce("before", F.lit(0))
    joined.withColumn("copy", copies).drop("t", "d", "before").write.parquet(f"{folder}/entries")
    committed = spark.read.parquet(f"{folder}/entries")

    # One row per shard; tasks are numbered in the order of the ranges.
    shards = committed.groupBy("task", "shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    shards.select("shard", base).write.parquet(f"{folder}/manifest")

    buckets = max(1, ceil(committed.count() / KEYS_PER_BUCKET))
    keyed = committed.select("shard", "place", "n_tokens", *key_hashes(buckets))
    index = keyed.groupBy("bucket").applyInPandas(build_bucket, INDEX)
    # A bucket without keys has no row, so their number is kept.
    index.withColumn("buckets", F.lit(buckets).cast("bigint")).write.parquet(f"{folder}/index")


def key_hashes(buckets: int) -> list[Column]:
    """Two hashes of a key, 128 bits, and its bucket."""
    first = F.xxhash64("doc_id", "copy")
    second = F.xxhash64(F.lit("second"), "copy", "doc_id")
    return [first.alias("first"), second.alias("second"), F.pmod(first, F.lit(buckets)).alias("bucket")]


INDEX = (
    "bucket bigint, level_sizes array<bigint>, bits binary, fingerprints binary, shards array<string>, "
    "shard_numbers binary, places binary, sizes binary"
)


def _mixed(first: np.ndarray, second: np.ndarray, level: int) -> np.ndarray:
    """A hash for each level: the finalizer of splitmix64 over both hashes of the key."""
    with np.errstate(over="ignore"):
        x = first ^ (second * np.uint64(2 * level + 1) + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _fingerprint(second: np.ndarray) -> np.ndarray:
    return (second >> np.uint64(32)).astype("<u4")


def build_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    """A minimal perfect hash of one bucket's keys, and a fingerprint and a place for each slot.

    Level by level, a key that is alone in its position sets that bit; the others go on to the next
    level. A key's slot is the number of bits set before its own, over all levels.
    """
    first, second = (rows[name].to_numpy().astype(np.uint64) for name in ("first", "second"))
    slots_at = np.empty(len(rows), dtype=np.int64)
    left, sizes, levels, taken = np.arange(len(rows)), [], [], 0
    while len(left):
        if len(sizes) == MAX_LEVELS:
            raise ValueError("two keys of a bucket have equal hashes")
        size = max(8, BITS_PER_KEY * len(left))
        position = (_mixed(first[left], second[left], len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(position, minlength=size)[position] == 1
        bits = np.zeros(size, dtype=bool)
        bits[position[alone]] = True
        slots_at[left[alone]] = taken + (np.cumsum(bits) - 1)[position[alone]]
        taken += int(bits.sum())
        sizes.append(size)
        levels.append(bits)
        left = left[~alone]
    by_slot = np.argsort(slots_at)
    shards, numbers = np.unique(rows["shard"].to_numpy().astype(str), return_inverse=True)
    return pd.DataFrame(
        {
            "bucket": [rows["bucket"].iloc[0]],
            "level_sizes": [sizes],
            "bits": [np.packbits(np.concatenate(levels)).tobytes()],
            "fingerprints": [_fingerprint(second)[by_slot].tobytes()],
            "shards": [shards.tolist()],
            "shard_numbers": [numbers.astype("<u4")[by_slot].tobytes()],
            "places": [rows["place"].to_numpy().astype("<u8")[by_slot].tobytes()],
            "sizes": [rows["n_tokens"].to_numpy().astype("<u8")[by_slot].tobytes()],
        }
    )


def look_up(keys: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """Places of one bucket's keys: a few bit tests and one fingerprint each; unknown keys are left out."""
    columns = [name for name in keys.columns if name not in ("first", "second", "bucket")]
    if index.empty:
        return keys.iloc[:0][columns].assign(shard="", place=0, n_tokens=0)
    row = index.iloc[0]
    first, second = (keys[name].to_numpy().astype(np.uint64) for name in ("first", "second"))
    total = int(sum(row["level_sizes"]))
    bits = np.unpackbits(np.frombuffer(row["bits"], dtype=np.uint8), count=total).astype(bool)
    rank = np.cumsum(bits) - 1
    slot = np.full(len(keys), -1, dtype=np.int64)
    left, start = np.arange(len(keys)), 0
    for level, size in enumerate(row["level_sizes"]):
        position = start + (_mixed(first[left], second[left], level) % np.uint64(size)).astype(np.int64)
        hit = bits[position]
        slot[left[hit]] = rank[position[hit]]
        left, start = left[~hit], start + int(size)
    prints = np.frombuffer(row["fingerprints"], dtype="<u4")
    known = (slot >= 0) & (prints[np.maximum(slot, 0)] == _fingerprint(second))
    slot = slot[known]
    numbers = np.frombuffer(row["shard_numbers"], dtype="<u4")[slot]
    return keys[known][columns].assign(
        shard=np.array(row["shards"], dtype=object)[numbers],
        place=np.frombuffer(row["places"], dtype="<u8")[slot].astype(np.int64),
        n_tokens=np.frombuffer(row["sizes"], dtype="<u8")[slot].astype(np.int64),
    )


def find(keys: DataFrame, folder: str) -> DataFrame:
    """shard, place and n_tokens for rows of (doc_id, copy), through the index; unknown keys are left out.

    A bucket of the index meets the keys that fall into it; repeated keys are found once.
    """
    index = keys.sparkSession.read.parquet(f"{folder}/index")
    buckets = index.agg(F.max("buckets")).first()[0] or 1
    wanted = keys.select("doc_id", "copy").distinct().select("doc_id", "copy", *key_hashes(buckets))
    kinds = ", ".join(f"{name} {wanted.schema[name].dataType.simpleString()}" for name in ("doc_id", "copy"))
    return (
        wanted.groupBy("bucket")
        .cogroup(index.groupBy("bucket"))
        .applyInPandas(look_up, f"{kinds}, shard string, place bigint, n_tokens bigint")
    )


def read_ids(found: DataFrame, folder: str, vocabulary: str) -> DataFrame:
    """`found` with `ids` (binary, unsigned 32 bit little-endian), `ids_crc32` of them, and `start`.

    `start` counts the ids of all documents before. Places are dealt by stretches of a shard, so a shard is opened by
    as many tasks as it has stretches, and each reads on in one direction; payload is never shuffled.
    """
    folder = _qualified(found.sparkSession, folder)
    manifest = found.sparkSession.read.parquet(f"{folder}/manifest")
    placed = found.join(manifest, "shard").withColumn("start", F.col("base") + F.col("place")).drop("base")
    stretch = F.floor(F.col("place") / STRETCH_IDS).alias("stretch")
    ids = found.sparkSession.read.parquet(f"{folder}/entries").agg(F.sum("n_tokens")).first()[0] or 0
    tasks = manifest.count() + ceil(ids / STRETCH_IDS)
    sorted_places = placed.repartition(max(1, tasks), "shard", stretch).sortWithinPartitions("shard", "place")
    narrow = np.dtype(WordEncoder(read_definition(vocabulary)).dtype)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _open(folder)
        name, file = None, None
        for batch in slices(batches):
            ids, sums = [], []
            shards, places, sizes = (batch.column(c).to_pylist() for c in ("shard", "place", "n_tokens"))
            for shard, place, size in zip(shards, places, sizes):
                if shard != name:
                    if file:
                        file.close()
                    name, file = shard, store.open_input_file(f"{path}/payload/{shard}.ids")
                raw = file.read_at(size * narrow.itemsize, place * narrow.itemsize)
                ids.append(np.frombuffer(raw, dtype=narrow).astype("<u4").tobytes())
                sums.append(zlib.crc32(ids[-1]))
            columns = [*batch.columns, pa.array(ids, pa.binary()), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "ids", "ids_crc32"])
        if file:
            file.close()

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sorted_places.schema)
    return sorted_places.mapInArrow(read, f"{kinds}, ids binary, ids_crc32 bigint")
