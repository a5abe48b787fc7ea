"""A corpus from raw documents to token ids, in five stages, each over all that its predecessor kept."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, jaccard, mixing, pii, quality
from millrace.llm.common import quoted, table, whole_text
from millrace.llm.queries import QUALITY_FROM, vocabulary
from millrace.operators import fresh_name
from millrace.sources import stage

# Near copies share at least so many percent of their shingles of so many words.
SIMILAR_PERCENT, SHINGLE_WORDS = 80, 5


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects; it is fitted on labelled documents of this input."""
    name = fresh_name("quality_score", docs)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, name=name).where(quoted(name) >= QUALITY_FROM).drop(name)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    return jaccard.drop_near_copies(docs, SIMILAR_PERCENT, SHINGLE_WORDS)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind in place of every span of personal data."""
    redacted = pii.redact(docs)
    n_chars = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))
    return redacted.withColumn("n_chars", n_chars)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents until the sources have their target weights."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids (little-endian, 32 bits each), n_tokens, and whether decoding gives the text back."""
    encoded = bpe.encode(docs, vocabulary("byte_bpe_50k.json"), keep=("source", "text"), decoded="back")
    return encoded.select(
        "doc_id",
        "source",
        "ids",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.col("back").eqNullSafe(whole_text()).alias("round_trip"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("near_copies", one_of_each),
    ("personal_data", without_personal_data),
    ("mixing", mixed),
    ("tokens", tokens),
]

# Classifiers, bootstrapped patterns and token ids are not SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
