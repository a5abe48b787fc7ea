"""Delimited lists in text columns."""

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The code points Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def explode_delimited(df: DataFrame, column: str, delimiter: str = ";", item: str = "item") -> DataFrame:
    """One row per list item, trimmed, without empty items; repeats are kept."""
    # split() takes a pattern, so the delimiter is quoted.
    pieces = F.split(column, re.escape(delimiter))
    exploded = df.select(F.explode(pieces).alias(item))
    return exploded.select(F.btrim(item, F.lit(WHITESPACE)).alias(item)).where(F.col(item) != "")


def count_distinct_items(df: DataFrame, column: str, delimiter: str = ";", name: str = "items") -> DataFrame:
    """Number of different items over all lists, as one row."""
    return explode_delimited(df, column, delimiter).agg(F.count_distinct("item").alias(name))
