"""Joining a fact to a lookup table whose keys are unique."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from millrace.operators.names import fresh_name
from millrace.sources import stage

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
SAMPLE_ROWS = 200_000  # looked at for hot keys
HOT_SHARE = 0.01
HOT_ROWS = 1_000_000  # of one key that a task sorts
HOT_SAMPLE = 0.001  # of the rows, to estimate those of a key

# Values without a bound on their size that is cheap to measure.
NESTED = (ArrayType, MapType, StructType, VariantType)


def fit_broadcast(
    frames: Sequence[DataFrame], max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> list[bool]:
    """Whether each frame is small enough, by rows and text bytes, in one job; nested columns never are."""

    def measured(number: int, df: DataFrame) -> DataFrame:
        width = F.lit(0)
        for name, kind in df.dtypes:
            column = F.col(f"`{name}`")
            size = F.octet_length(column) if kind in ("string", "binary") else F.lit(8)
            width = width + F.coalesce(size, F.lit(0))
        return df.agg(
            F.lit(number).alias("frame"), F.count("*").alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("size")
        )

    plain = {i: df for i, df in enumerate(frames) if not any(isinstance(f.dataType, NESTED) for f in df.schema)}
    fits = [False] * len(frames)
    if plain:
        sizes = reduce(DataFrame.unionByName, [measured(i, df) for i, df in plain.items()])
        for row in sizes.collect():  # one row per frame
            fits[row["frame"]] = row["rows"] <= max_rows and row["size"] <= max_bytes
    return fits


def _quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def _join_in_pieces(fact: DataFrame, lookup: DataFrame, on: str, hot: DataFrame) -> DataFrame:
    """Inner join by sort and merge, where the rows of `hot` keys (key, number of pieces) are dealt out in pieces."""
    pieces, salt = fresh_name("pieces", fact, lookup), fresh_name("salt", fact, lookup)
    cut = F.broadcast(hot.toDF(on, pieces))
    alone = [f.name for f in fact.schema if [n.lower() for n in fact.columns].count(f.name.lower()) == 1]
    plain = [f.name for f in fact.schema if f.name in alone and not isinstance(f.dataType, NESTED)]
    # By the row's values, so that a task that runs again deals as before.
    piece = F.pmod(F.xxhash64(*map(_quoted, plain)), _quoted(pieces))
    dealt = fact.join(cut, on, "left").withColumn(salt, F.coalesce(piece, F.lit(0))).drop(pieces)
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(_quoted(pieces), F.lit(1)) - 1))
    repeated = lookup.join(cut, on, "left").withColumn(salt, each).drop(pieces)
    return dealt.join(repeated.hint("merge"), [on, salt]).drop(salt)


def join_lookup(
    fact: DataFrame,
    lookup: DataFrame,
    on: str,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    small: bool | None = None,
    keys: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    hot_sample: float = HOT_SAMPLE,
) -> DataFrame:
    """Inner join on a column that is unique in the lookup.

    A lookup measured to be small is broadcast: the fact is not shuffled, whatever its skew. With a
    larger one both sides are shuffled and sorted, and adaptive execution splits the partitions of hot
    keys, repeating the lookup's one row; `stage` a lookup that an aggregate makes, as Spark splits only
    what it shuffles for the join. `small` says what a caller has measured already.

    Adaptive execution goes by compressed bytes, of which a hot key's rows may be few. So the fact is read first, and the
    rows of a key that a sample shows to have more than `hot_rows` are dealt out in pieces by the hash of their
    values, each with the lookup's row; rows equal in all columns stay in one. `stage` a fact that is costly to compute, or
    give `keys`, a frame with the fact's keys that is cheaper to read. The sample decides how a row is joined, never whether.
    """
    if small is None:
        (small,) = fit_broadcast([lookup], max_rows, max_bytes)
    if small:
        return fact.join(F.broadcast(lookup), on)
    sampled = (fact if keys is None else keys).select(_quoted(on)).sample(hot_sample, seed=1)
    pieces = fresh_name("pieces", sampled)
    counts = sampled.where(_quoted(on).isNotNull()).groupBy(_quoted(on))
    cut = counts.agg(F.ceil(F.count("*") / F.lit(hot_sample * hot_rows)).alias(pieces))
    hot = stage(cut.where(F.col(pieces) > 1), "hot")
    if hot.isEmpty():
        return fact.join(lookup.hint("merge"), on)
    return _join_in_pieces(fact, lookup, on, hot)


def join_lookup_split(
    fact: DataFrame, lookup: DataFrame, on: str, sample_rows: int = SAMPLE_ROWS, hot_share: float = HOT_SHARE
) -> DataFrame:
    """Inner join of a staged fact with a large lookup that is unique in the column, apart for hot keys.

    A sample tells which keys have `hot_share` of the fact's rows or more, so no more than 1 / hot_share of them. Their
    lookup rows are broadcast, so the rows of hot keys are not shuffled; all others are joined by sort and merge, and the
    two results united. The sample decides how a row is joined, never whether. Without a hot key it is one plain join.
    """
    rows = fact.count()
    sampled = fact.select(on).sample(min(1.0, sample_rows / max(1, rows)), seed=1)
    found = sampled.groupBy(on).count()
    n = F.sum("count").over(Window.partitionBy())
    # The window runs over the keys of the sample.
    hot = found.withColumn("all", n).where((F.col("count") > 1) & (F.col("count") >= F.col("all") * hot_share)).select(on)
    hot_lookup = stage(lookup.join(F.broadcast(hot), on), "hot")
    if hot_lookup.isEmpty():
        return fact.join(lookup.hint("merge"), on)
    often = fact.join(F.broadcast(hot_lookup), on)
    rest = fact.join(F.broadcast(hot_lookup.select(on)), on, "left_anti")
    return often.unionByName(rest.join(lookup.hint("merge"), on))
