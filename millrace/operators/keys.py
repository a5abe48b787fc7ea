"""Rows with all keys."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keys_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Leave out rows where one of the columns is NULL.

    Separate conditions, unlike `dropna`, are pushed down to the file scan.
    """
    if not columns:
        return df
    return df.where(reduce(Column.__and__, [F.col(name).isNotNull() for name in columns]))
