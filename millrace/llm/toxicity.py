"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic text, one on ordinary text. A window of a document is
compressed with both; the bytes that the toxic dictionary saves against the ordinary one are its
difference. Each difference has a weight, how much more often toxic documents have such windows; the highest
sum over STRETCH_WORDS windows in a row, against calibrated thresholds, gives the document's score, so that
a toxic passage counts as much in a long text as in a short one.

A window is one word in a fixed frame. Longer windows bury the few bytes that an insult saves in the
noise of two dictionaries (windows of 4, 6, 8 and 16 words, with dictionaries trained on whole texts, on what the
ordinary dictionary compresses worst, or on passages around loud words, get 88 to 92 % of held-out labels right, where
88 % have label 0; single words get 97 %), and zstandard finds no match in the last eight bytes of an input, hence
the frame's margin. Toxic documents are mostly ordinary text, so the toxic samples are those words that
stand out in them: by documents and by neighbours on either side, whichever are fewest, so that neither
one long document nor many copies of a passage count as evidence.

Defined cases: a null or empty text has no windows and gets the score of such texts; rows are scored one
by one, so repeated rows fare alike; without labels of both kinds, or without words that stand out, the
score is the share of label 1 among the fitted rows, 0.5 if there are none; an empty table gives no rows;
further columns are ignored.
"""

import random
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bpe import BoundedCache
from millrace.llm.common import in_small_batches, slices, whole_text
from millrace.llm.samples import labelled_texts
from millrace.sources import stage

FIT_ROWS = 8_000  # labelled documents that the model is fitted on, at most
TOXIC_WORDS = 1_000  # words that stand out, at most
ORDINARY_WORDS = 20_000  # the most frequent ones
REPEATS = 400  # of one word among the training windows, at most
WORDS_PER_SAMPLE = 8
DICTIONARY_BYTES = {"toxic": 4_096, "ordinary": 32_768}
LEVEL = 3
MIN_SURPRISE = 4.0  # standard deviations above the expected count
TOP_DIFFERENCE = 12  # bytes; higher ones count as this
LEVELS = 12  # thresholds between scores
STRETCH_WORDS = 1_000
CACHED_WORDS = 300_000
MARGIN = b"\n" * 12

PARTS = re.compile(r"[^\W_]+").findall


@dataclass(frozen=True)
class ToxicModel:
    """Dictionaries, a weight per difference from 0 on, and the scores between ascending thresholds."""

    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]
    thresholds: tuple[float, ...]
    scores: tuple[float, ...]


class _Windows:
    """Differences of windows, kept per word."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.compressors = [self._compressor(d) for d in (ordinary, toxic)]
        self.differences = BoundedCache(self._difference, CACHED_WORDS)

    @staticmethod
    def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
        data = zstandard.ZstdCompressionDict(dictionary)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            dict_data=data, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
        )

    def _difference(self, word: str) -> int:
        """The highest difference of the parts between punctuation; 0 if there is none."""
        best = 0
        for part in PARTS(word):
            window = b" " + part.encode() + b" " + MARGIN
            ordinary, toxic = (len(c.compress(window)) for c in self.compressors)
            best = max(best, ordinary - toxic)
        return min(best, TOP_DIFFERENCE)

    def _each(self, text: str) -> list[int]:
        return list(map(self.differences.__getitem__, text.lower().split()))

    def counts(self, text: str) -> list[int]:
        """How many windows of the text have each difference from 0 on."""
        found = Counter(self._each(text))
        return [found[d] for d in range(TOP_DIFFERENCE + 1)]

    def best_stretch(self, text: str, weights: np.ndarray) -> float:
        """The highest sum of weights over STRETCH_WORDS windows in a row; over all of them if they are fewer."""
        sums = np.concatenate(([0.0], np.cumsum(weights[np.array(self._each(text), dtype=np.int64)])))
        return float((sums[STRETCH_WORDS:] - sums[:-STRETCH_WORDS]).max() if len(sums) > STRETCH_WORDS else sums[-1])


@lru_cache(maxsize=2)
def _windows(toxic: bytes, ordinary: bytes) -> _Windows:
    return _Windows(toxic, ordinary)


def word_evidence(rows: DataFrame) -> DataFrame:
    """word, toxic, ordinary: in how many documents, after and before how many different words, whichever is least."""
    texts = rows.groupBy("text").agg(F.max("label").alias("label"), F.min("doc_id").alias("doc_id"))
    listed = texts.select(
        "doc_id", "label", F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)).alias("words")
    )
    around = F.transform(
        "words",
        lambda w, i: F.struct(
            w.alias("word"),
            F.xxhash64(F.coalesce(F.get("words", i - 1), F.lit(""))).alias("before"),
            F.xxhash64(F.coalesce(F.get("words", i + 1), F.lit(""))).alias("after"),
        ),
    )
    each = listed.select("doc_id", "label", F.explode(around).alias("w")).select("label", "doc_id", "w.*")
    kinds = F.explode(
        F.array(
            *[
                F.struct(F.lit(kind).alias("kind"), F.xxhash64(name).alias("value"))
                for kind, name in enumerate(("doc_id", "before", "after"))
            ]
        )
    )
    distinct = each.select("label", "word", kinds.alias("k")).select("label", "word", "k.*").distinct()
    counts = distinct.groupBy("label", "word", "kind").count().groupBy("label", "word").agg(F.min("count").alias("n"))
    return counts.groupBy("word").agg(
        F.coalesce(F.sum(F.when(F.col("label") == 1, F.col("n"))), F.lit(0)).alias("toxic"),
        F.coalesce(F.sum(F.when(F.col("label") == 0, F.col("n"))), F.lit(0)).alias("ordinary"),
    )


def _samples(words: list[tuple[str, int]]) -> list[bytes]:
    """Training texts: the words by their counts, in a fixed random order."""
    bag = [word for word, count in words for _ in range(min(count, REPEATS))]
    random.Random(17).shuffle(bag)
    return [f" {' '.join(bag[i : i + WORDS_PER_SAMPLE])} ".encode() for i in range(0, len(bag), WORDS_PER_SAMPLE)]


def _dictionary(words: list[tuple[str, int]], size: int) -> bytes:
    """Trained, or the texts themselves where there are too few to train on."""
    samples = _samples(words)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def _measured(rows: DataFrame, toxic: bytes, ordinary: bytes, measure: Callable, kind: tuple[str, pa.DataType], *keep: str) -> DataFrame:
    """The columns in `keep`, and `measured`: what `measure` makes of the windows and each whole text."""
    own = rows.select(*keep, whole_text().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows(toxic, ordinary)
        for batch in slices(batches):
            found = [measure(windows, text) for text in batch.column("text").to_pylist()]
            kept = [batch.column(name) for name in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, kind[1])], [*keep, "measured"])

    kinds = [f"`{name}` {own.schema[name].dataType.simpleString()}" for name in keep]
    return in_small_batches(own).mapInArrow(run, ", ".join([*kinds, f"measured {kind[0]}"]))


def _window_counts(rows: DataFrame, toxic: bytes, ordinary: bytes, *keep: str) -> DataFrame:
    counts = lambda windows, text: windows.counts(text)
    return _measured(rows, toxic, ordinary, counts, ("array<bigint>", pa.list_(pa.int64())), *keep)


def _best_stretches(rows: DataFrame, toxic: bytes, ordinary: bytes, weights: tuple[float, ...], *keep: str) -> DataFrame:
    each = np.array(weights)
    best = lambda windows, text: windows.best_stretch(text, each)
    return _measured(rows, toxic, ordinary, best, ("double", pa.float64()), *keep)


def _weights(rows: list[tuple[int, list[int]]]) -> tuple[float, ...]:
    """Logarithms of how the share of a difference among windows differs between toxic and ordinary documents."""
    totals = [[1.0 + sum(c[d] for label, c in rows if label == k) for d in range(TOP_DIFFERENCE + 1)] for k in (0, 1)]
    sums = [sum(t) for t in totals]
    return tuple(log(totals[1][d] / sums[1]) - log(totals[0][d] / sums[0]) for d in range(TOP_DIFFERENCE + 1))


def _calibrated(rows: list[tuple[float, int]]) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Thresholds and scores: shares of label 1 that rise with the sum, by pooling neighbours that do not.

    A threshold lies halfway between the pools it parts.
    """
    pools: list[list[float]] = []  # lowest sum, highest sum, rows, rows with label 1

    def join_last() -> None:
        _, highest, n, ones = pools.pop()
        pools[-1][1:] = highest, pools[-1][2] + n, pools[-1][3] + ones

    for total, label in sorted(rows):
        pools.append([total, total, 1, label])
        while len(pools) > 1 and (pools[-2][1] == total or pools[-2][3] * pools[-1][2] >= pools[-1][3] * pools[-2][2]):
            join_last()
    while len(pools) > LEVELS:
        # The smallest pool joins the one before.
        after = min(range(1, len(pools)), key=lambda i: pools[i][2]) + 1
        rest, pools[after:] = pools[after:], []
        join_last()
        pools.extend(rest)
    thresholds = tuple((before[1] + pool[0]) / 2 for before, pool in zip(pools, pools[1:]))
    least = 0.5 / (len(rows) + 1)
    return thresholds, tuple(min(max(ones / n, least), 1 - least) for _, _, n, ones in pools)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", fit_rows: int = FIT_ROWS) -> ToxicModel:
    """The driver sees counts of words and of windows only, bounded by the constants above."""
    rows = stage(labelled_texts(docs, labels, label, fit_rows).where(F.col("label").isin(0, 1)), "toxicity")
    counts = {row["label"]: row["count"] for row in rows.groupBy("label").count().collect()}
    total = sum(counts.values())
    plain = ToxicModel(b"", b"", (), (), (counts.get(1, 0) / total if total else 0.5,))
    if len(counts) < 2:
        return plain
    evidence = stage(word_evidence(rows), "evidence")
    all_toxic, all_ordinary = evidence.agg(F.sum("toxic"), F.sum("ordinary")).first()
    if not all_toxic or not all_ordinary:
        return plain
    expected = (F.col("toxic") + F.col("ordinary")) * F.lit(all_toxic / (all_toxic + all_ordinary))
    surprise = ((F.col("toxic") - expected) / F.sqrt(expected + 1)).alias("surprise")
    loud = evidence.select("word", "toxic", surprise).where(F.col("surprise") >= MIN_SURPRISE)
    top = loud.orderBy(F.desc("surprise"), "word").limit(TOXIC_WORDS).collect()
    if not top:
        return plain
    toxic = _dictionary([(r["word"], r["toxic"]) for r in top], DICTIONARY_BYTES["toxic"])
    common = evidence.where(F.col("ordinary") > 0).orderBy(F.desc("ordinary"), "word").limit(ORDINARY_WORDS)
    ordinary = _dictionary([(r["word"], r["ordinary"]) for r in common.collect()], DICTIONARY_BYTES["ordinary"])
    counted = _window_counts(rows, toxic, ordinary, "label").collect()
    weights = _weights([(r["label"], r["measured"]) for r in counted])
    sums = [(r["measured"], r["label"]) for r in _best_stretches(rows, toxic, ordinary, weights, "label").collect()]
    return ToxicModel(toxic, ordinary, weights, *_calibrated(sums))


def score(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """doc_id and score."""
    if not model.toxic:
        return docs.select("doc_id", F.lit(model.scores[0]).alias("score"))
    best = _best_stretches(docs, model.toxic, model.ordinary, model.weights, "doc_id")
    scores = F.lit(model.scores[0])
    for threshold, value in zip(model.thresholds, model.scores[1:]):
        scores = F.when(F.col("measured") >= threshold, value).otherwise(scores)
    return best.select("doc_id", scores.alias("score"))
