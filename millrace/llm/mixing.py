"""Mixing sources to target weights.

Every source gets a target in words; a document is taken floor(rate) times and once more with the
probability of the fraction, by a draw seeded with its id, where rate = target / size of its source.

Defined cases: a null text has size 0; a null source is a source of its own, last in the order; documents
without an id draw by a digest of their text; repeated rows draw alike; an empty table gives no rows; a
mix of empty texts takes every document no times. `mix` keeps all columns, whatever their names.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD, quoted, whole_text
from millrace.operators import fresh_name, join_lookup
from millrace.sources import stage

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
SEED = "mix-1"
DIGITS = 13  # hexadecimal digits of the draw: 52 bits, exact in a double


def draw(doc_id: Column, text: Column) -> Column:
    """A number in [0, 1) that depends on the document alone, so reruns agree."""
    key = F.coalesce(doc_id.cast("string"), F.md5(text.cast("binary")), F.lit(""))
    digest = F.md5(F.concat(F.lit(f"{SEED}:"), key).cast("binary"))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("bigint") / F.lit(16.0**DIGITS)


def source_targets(sizes: DataFrame, max_repeat: int = MAX_REPEAT, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source: source_key, source_size, target.

    Weights go by code point order, null last, and share the whole size. Taking the sources by the level
    at which they reach their bound, the common level is the highest that any of them would see with all
    before it bounded; a target is the weight times that level, or the bound. The windows run over one
    row per source.
    """
    by_source = sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    listed = F.array(*[F.lit(w) for w in weights])
    number = F.row_number().over(Window.orderBy("source_key"))
    weighed = by_source.withColumn("weight", F.get(listed, (number - 1) % len(weights)).cast("bigint"))
    bound = F.col("source_size") * max_repeat
    everything = Window.partitionBy()
    before = Window.orderBy(bound / F.col("weight"), "source_key").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(bound).over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = weighed.withColumn("level", left / weight_left)
    target = F.least(bound.cast("double"), F.col("weight") * F.max("level").over(everything))
    return levels.select("source_key", "source_size", target.alias("target"))


def source_key(source: str) -> Column:
    """The source as a key that is never null and sorts by code point, null last."""
    named = F.concat(F.lit("a"), F.col(source).cast("string"))
    return F.when(F.col(source).isNull(), "n").otherwise(named)


def n_words(text: str) -> Column:
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("bigint")


def copies(target: Column, source_size: Column, drawn: Column) -> Column:
    """floor(rate), and one more if the draw falls below the fraction."""
    rate = F.coalesce(F.try_divide(target, source_size.cast("double")), F.lit(0.0))
    return (F.floor(rate) + F.when(drawn < rate - F.floor(rate), 1).otherwise(0)).cast("bigint")


def copies_per_document(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size, source_size, target and copies of each document.

    The sizes are staged: the texts are read once, and the hot source is counted within its tasks.
    """
    sizes = stage(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            source_key(source).alias("source_key"),
            n_words(text).alias("size"),
            draw(F.col(doc_id), F.col(text)).alias("draw"),
        ),
        "mixing",
    )
    planned = join_lookup(sizes, source_targets(sizes), "source_key")
    taken = copies(F.col("target"), F.col("source_size"), F.col("draw"))
    return planned.select("doc_id", "size", "source_size", "target", taken.alias("copies"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixed documents: every row as often as it is taken, with its own columns.

    The copies follow from the source's rate and the row's own draw, so no row meets another: the rates
    are joined to the documents, one row per source.
    """
    key, total, share, copy = (fresh_name(f"mix_{name}", docs) for name in ("key", "total", "share", "copy"))
    sizes = docs.select(source_key(source).alias("source_key"), n_words(text).alias("size"))
    targets = source_targets(sizes).toDF(key, total, share)
    planned = join_lookup(docs.withColumn(key, source_key(source)), targets, key)
    taken = copies(F.col(share), F.col(total), draw(F.col(doc_id), F.col(text)))
    repeated = planned.withColumn(copy, F.explode(F.sequence(F.lit(0), taken))).where(F.col(copy) > 0)
    return repeated.select(*[quoted(name) for name in docs.columns])
