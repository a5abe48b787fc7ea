"""Dimensions: distinct values of a column with ids 1..n in value order."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.names import fresh_name
from millrace.operators.sequence import sequence_id
from millrace.sources import stage

ONE_TASK_ROWS = 1_000_000  # up to this many distinct values one task numbers them


def surrogate_key(
    values: DataFrame, column: str, id_name: str, rows: int | None = None, one_task_rows: int = ONE_TASK_ROWS
) -> DataFrame:
    """Number rows by `column`, NULL last. `rows` saves the count where it is known."""
    if (values.count() if rows is None else rows) <= one_task_rows:
        rank = F.row_number().over(Window.orderBy(F.col(column).asc_nulls_last()))
        return values.select(rank.cast("bigint").alias(id_name), column)
    missing = fresh_name("missing", values)
    keyed = values.withColumn(missing, F.col(column).isNull())
    return sequence_id(keyed, id_name, [missing, column], rows_per_task=one_task_rows).select(id_name, column)


def dimensions(
    df: DataFrame,
    columns: Mapping[str, tuple[str, Column]],
    keep_null: bool = False,
    one_task_rows: int = ONE_TASK_ROWS,
) -> dict[str, DataFrame]:
    """All dimensions of a frame: {id name: (value name, text expression)}.

    One distinct per column, so that each reads only its column and aggregates within the task: a
    value that fills the table leaves each task once. The distinct values are staged together, as
    both the keys and the fact read them.
    """

    def distinct(id_name: str, expr: Column) -> DataFrame:
        values = df.select(F.lit(id_name).alias("dim"), expr.alias("value"))
        return (values if keep_null else values.where(F.col("value").isNotNull())).distinct()

    values = stage(
        reduce(DataFrame.unionByName, [distinct(id_name, expr) for id_name, (_, expr) in columns.items()]),
        "dimensions",
    )
    sizes = {row["dim"]: row["count"] for row in values.groupBy("dim").count().collect()}
    return {
        id_name: surrogate_key(
            values.where(F.col("dim") == id_name).select(F.col("value").alias(value_name)),
            value_name,
            id_name,
            sizes.get(id_name, 0),
            one_task_rows,
        )
        for id_name, (value_name, _) in columns.items()
    }


def dimension(df: DataFrame, id_name: str, value_name: str, expr: Column, keep_null: bool = False) -> DataFrame:
    """One dimension; `expr` may be computed, such as a decoded label."""
    return dimensions(df, {id_name: (value_name, expr)}, keep_null)[id_name]
