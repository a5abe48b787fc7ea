"""Gapless 1..n ids in a global order, computed by many tasks.

`row_number()` over an ordering alone moves every row to one task. Here rows are dealt to tasks by ranges
of the whole order and sorted within each; a row's place in its task is written with it, so that

    id = rows in earlier tasks + place in its own

holds for every later reader, whatever is computed again. Ranges come from Spark's own sample; a poor one
costs balance, never correctness.

For several orders of many rows, these are written once, as they come, with a number of their own. Each order deals and
writes only that number and its keys, and the ids come back to the rows by one join, however many orders there are.
Few rows are dealt and written whole once per order, which takes fewer jobs.
"""

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.names import fresh_name
from millrace.sources import stage

ROWS_PER_TASK = 1_000_000
MIN_ROWS_PER_TASK = 1_000
SMALL_TASKS = 1_000  # no more of fewer than ROWS_PER_TASK rows: each has 300 sampled keys and its results sent to the driver
TASKS_PER_CORE = 2  # where the data is small
NARROW_ROWS = 5_000_000  # from so many rows on, several orders deal row numbers and keys only
HOT = 4  # times the mean rows of a task

PLACE_BITS = 33  # of monotonically_increasing_id: the place, below the number of the task


def _numbered(
    df: DataFrame, name: str, keys: Sequence[str], rows: int, tasks: int, keep: Sequence[str], salted: bool = False
) -> DataFrame:
    """The `keep` columns and one id; the rows are shuffled once, with their keys, and written once, without."""
    place, task, offset = (fresh_name(base, df) for base in ("place", "task", "offset"))
    ranged = df.repartitionByRange(tasks, *map(_quoted, keys)).sortWithinPartitions(*map(_quoted, keys))
    # Numbers the rows of a task in order, from the task's number shifted on.
    placed = stage(ranged.select(*map(_quoted, keep), F.monotonically_increasing_id().alias(place)), "sequence")
    task_of = F.shiftright(place, PLACE_BITS)
    # One row per task: small enough for one task and for a broadcast.
    counts = stage(placed.groupBy(task_of.alias(task)).agg(F.count("*").alias(offset)), "sequence")
    if tasks > 1 and not salted and (counts.agg(F.max(offset)).first()[0] or 0) > HOT * rows / tasks:
        # Rows equal in the whole order fill a task, and theirs is free: spread them at random. Writing
        # them first fixes the salt, so that every pass and retry sees the same.
        salt = fresh_name("salt", df)
        spread = stage(df.withColumn(salt, F.rand()), "sequence")
        return _numbered(spread, name, [*keys, salt], rows, tasks, keep, salted=True)
    before = Window.orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(task, F.coalesce(F.sum(offset).over(before), F.lit(0)).alias(offset))
    joined = placed.withColumn(task, task_of).join(F.broadcast(offsets), task)
    number = F.col(offset) + F.col(place).bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) + 1
    return joined.select(*map(_quoted, keep), number.alias(name))


def _quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def sequence_ids(
    df: DataFrame,
    orders: Mapping[str, Sequence[str]],
    rows_per_task: int = ROWS_PER_TASK,
    tasks: int | None = None,
    narrow_rows: int = NARROW_ROWS,
) -> DataFrame:
    """Add a 1..n bigint column per entry of `orders`: {id name: ascending order columns}, NULL first.

    Works when called: the rows are counted, and written and shuffled once; from `narrow_rows` on, further orders deal
    and write their keys only, below it the whole rows. Select the columns of use before, and `stage` an input that is costly to
    compute. The tasks follow the rows, not the session's number of shuffle partitions: `rows_per_task` each, or more where
    that made over `SMALL_TASKS` of fewer than `ROWS_PER_TASK`. Rows equal in all order columns get their ids in no fixed
    order, so add a tie-breaker where ids must be reproducible.
    """
    columns = df.columns
    row = fresh_name("row", df)
    rows = df.count()
    if tasks is None:
        small = min(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism, rows // MIN_ROWS_PER_TASK)
        most = max(SMALL_TASKS, ceil(rows / ROWS_PER_TASK))
        tasks = max(min(ceil(rows / rows_per_task), most), small)
    tasks = max(1, min(tasks, rows))
    if len(orders) == 1 or rows < narrow_rows:
        for name, keys in orders.items():
            df = _numbered(df, name, keys, rows, tasks, df.columns)
        return df
    df = stage(df.withColumn(row, F.monotonically_increasing_id()), "sequence")
    each = [
        _numbered(df.select(row, *map(_quoted, dict.fromkeys(keys))), name, keys, rows, tasks, [row])
        for name, keys in orders.items()
    ]
    ids = reduce(lambda a, b: a.join(b, row), each)
    return df.join(ids, row).select(*map(_quoted, [*columns, *orders]))


def sequence_id(df: DataFrame, name: str, keys: Sequence[str], **options: int) -> DataFrame:
    """`sequence_ids` for a single order."""
    return sequence_ids(df, {name: keys}, **options)
