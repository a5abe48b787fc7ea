"""Quality by votes of nearest labelled neighbours in a latent-semantic space.

A text becomes the counts of its hashed byte trigrams, damped and weighted, and beside them the shares of
a few habits, such as saying the last word again, that no single trigram shows. These are projected onto
the leading singular vectors of a bounded sample of labelled texts. A text's score is the share of label
1 among the nearest labelled texts, weighted by similarity; the cosine products with all of them are
exact, block by block.

Defined cases: a null text is empty; a text too short for a trigram has no direction and gets the share
of label 1 among the fitted rows, 0.5 if there are none; rows are scored one by one, so repeated rows
fare alike; ties among neighbours go to the one fitted first; an empty table gives no rows; further
columns are ignored.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import in_small_batches, slices, whole_text
from millrace.llm.samples import labelled_texts

FEATURE_BITS = 10
FIT_ROWS = 3_000  # labelled documents that are voters, at most; 64 floats each are broadcast
FEATURES = 1 << FEATURE_BITS
DIMENSIONS = 64
NEIGHBOURS = 25
BLOCK = 256  # texts at once
HABIT_WEIGHT = 2.0  # of all habits, against all trigrams
SHARPNESS = 8  # a neighbour's weight is its similarity to this power


_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | (_BYTES >= 97) & (_BYTES <= 122) | (_BYTES >= 128)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_MARK = (_BYTES > 32) & (_BYTES < 127) & ~_LETTER & ~_DIGIT
HABITS = 4
WIDTH = FEATURES + 2 * HABITS


def _habits(text: str, data: np.ndarray) -> list[float]:
    """Shares: words like the one before, capital letters, marks and digits."""
    words = text.split()
    byte_counts = np.bincount(data, minlength=256)
    letters, visible = byte_counts[_LETTER].sum(), byte_counts[33:].sum()
    return [
        sum(map(eq, words, words[1:])) / max(1, len(words) - 1),
        byte_counts[_UPPER].sum() / max(1, letters),
        byte_counts[_MARK].sum() / max(1, visible),
        byte_counts[_DIGIT].sum() / max(1, visible),
    ]


def text_features(texts: list[str]) -> np.ndarray:
    """One row per whole text: log of 1 + count of each hashed byte trigram, then two values for each habit."""
    rows = np.zeros((len(texts), WIDTH), dtype=np.float32)
    for row, text in enumerate(texts):
        data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
        if len(data) >= 3:
            code = data[:-2].astype(np.uint32) << 16 | data[1:-1].astype(np.uint32) << 8 | data[2:]
            hashed = (code * np.uint32(2654435761)) >> np.uint32(32 - FEATURE_BITS)
            rows[row, :FEATURES] = np.log1p(np.bincount(hashed, minlength=FEATURES))
            shares = np.array(_habits(text, data))
            # Roots of a share and of its rest have unit length together.
            rows[row, FEATURES:] = np.sqrt(np.concatenate([shares, 1 - shares]) / HABITS)
    return rows


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt((rows * rows).sum(axis=1, keepdims=True)), 1e-12)


def _balanced(rows: np.ndarray) -> np.ndarray:
    """Trigrams at unit length beside the habits."""
    return np.concatenate([_unit(rows[:, :FEATURES]), rows[:, FEATURES:]], axis=1)


@dataclass(frozen=True)
class QualityModel:
    """`projection` holds weights and singular vectors in one; `voters` are unit vectors."""

    projection: np.ndarray
    voters: np.ndarray
    labels: np.ndarray
    share: float

    def scores(self, texts: list[str]) -> np.ndarray:
        counts = text_features(texts)
        out = np.full(len(texts), self.share)
        with_direction = counts.any(axis=1)
        if not len(self.voters) or not with_direction.any():
            return out
        vectors = _unit(_balanced(counts[with_direction]) @ self.projection)
        products = vectors @ self.voters.T
        k = min(NEIGHBOURS, len(self.voters))
        near = np.argpartition(-products, k - 1, axis=1)[:, :k]
        weights = np.maximum(np.take_along_axis(products, near, axis=1), 1e-6).astype(np.float64) ** SHARPNESS
        out[with_direction] = (weights * self.labels[near]).sum(axis=1) / weights.sum(axis=1)
        return np.clip(out, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS) -> QualityModel:
    """Features are counted by the tasks; the driver gets `fit_rows` rows of them, 13 MB at most."""
    rows = labelled_texts(docs, labels, label, fit_rows).where(F.col("label").isin(0, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts = [row.tobytes() for row in text_features(batch.column("text").to_pylist())]
            columns = [batch.column("doc_id"), batch.column("label"), pa.array(counts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "counts"])

    kinds = ", ".join(f"{name} {rows.schema[name].dataType.simpleString()}" for name in ("doc_id", "label"))
    sample = in_small_batches(rows).mapInArrow(run, f"{kinds}, counts binary").orderBy("doc_id").collect()
    votes = np.array([row["label"] for row in sample], dtype=np.float64)
    share = float(votes.mean()) if len(votes) else 0.5
    counts = np.array([np.frombuffer(row["counts"], dtype=np.float32) for row in sample]).reshape(-1, WIDTH)
    votes, counts = votes[counts.any(axis=1)], counts[counts.any(axis=1)]
    if not len(counts):
        return QualityModel(np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), votes, share)
    # Trigrams that every text has alike say little: the weight falls with their entropy over the texts.
    shares = counts / np.maximum(counts.sum(axis=0), 1e-12)
    entropy = -(shares * np.log(np.maximum(shares, 1e-30))).sum(axis=0) / max(np.log(len(counts)), 1.0)
    weights = np.clip(1 - entropy, 0.01, 1).astype(np.float32)
    typical = np.sqrt(((_unit(counts[:, :FEATURES]) * weights[:FEATURES]) ** 2).sum(axis=1).mean())
    weights[:FEATURES] /= max(typical, 1e-12)
    weights[FEATURES:] = HABIT_WEIGHT
    weighted = _balanced(counts) * weights
    _, vectors = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
    projection = (weights[:, None] * vectors[:, ::-1][:, :DIMENSIONS]).astype(np.float32)
    return QualityModel(projection, _unit(_balanced(counts) @ projection), votes, share)


def score(docs: DataFrame, model: QualityModel, text: str = "text", name: str = "score") -> DataFrame:
    """The documents with a column for the score, in place of one of that name if there is one.

    The broadcast model has a fixed size, 1.2 MB at most. Only the texts go to Python, and scores come back.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [shared.value.scores(texts.iloc[i : i + BLOCK].tolist()) for i in range(0, len(texts), BLOCK)]
            yield pd.Series(np.concatenate([np.empty(0), *parts]))

    return in_small_batches(docs).withColumn(name, scores(whole_text(text)))
