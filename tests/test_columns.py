import datetime
import math

import pytest
from pyspark.sql import functions as F

from millrace import functions as fn

DATE = datetime.date(2014, 5, 9)


def apply(spark, build, values, kind):
    """Results of a one-column builder, in input order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, c {kind}")
    return [row.r for row in rows.select("i", build(F.col("c")).alias("r")).orderBy("i").collect()]


PASSENGERS = [0.0, 1.0, 2.0, 2.5, 3.0, 4.0, 5.0, -1.0, None]


def test_passenger_load_exact(spark):
    want = ["Unknown", "Low", "Low", "Unknown", "Medium", "Medium", "Full", "Unknown", "Unknown"]
    assert apply(spark, fn.passenger_load_exact, PASSENGERS, "double") == want


def test_passenger_load_threshold(spark):
    want = ["Low", "Low", "Low", "Medium", "Medium", "Medium", "Full", "Low", "Unknown"]
    assert apply(spark, fn.passenger_load_threshold, PASSENGERS, "double") == want


def test_distance_length(spark):
    values = [0.99, 1.0, 4.99, 5.0, 9.99, 10.0, math.nan, -3.0, None]
    want = ["Unknown", "Short", "Short", "Medium", "Medium", "Long", "Long", "Unknown", "Unknown"]
    assert apply(spark, fn.distance_length, values, "double") == want


def test_decode_labels(spark):
    values = ["H", "L", "M", "C", "h", "High", "X", "", None]
    once = apply(spark, fn.decode_labels, values, "string")
    assert once == ["High", "Low", "Medium", "Cold", "h", "High", "X", "", None]
    assert apply(spark, fn.decode_labels, once, "string") == once


def test_strict_dates(spark):
    values = ["05/09/2014", "5/9/2014", "02/30/2014", "2014-05-09", "junk", "", None]
    assert apply(spark, fn.parse_date, values, "string") == [DATE, None, None, None, None, None, None]


def test_lenient_dates(spark):
    values = ["05/09/2014", "5/9/2014", "2014-05-09", "02/30/2014", "2014/05/09", "junk", "", None]
    want = [DATE, DATE, DATE, None, None, None, None, None]
    assert apply(spark, lambda c: fn.parse_date(c, fn.LENIENT_DATES), values, "string") == want


def test_pattern_without_separator(spark):
    assert apply(spark, lambda c: fn.parse_date(c, ["yyyyMMdd"]), ["20140509", "junk"], "string") == [DATE, None]


def test_lead_time(spark):
    pairs = [("01/01/2014", "01/05/2014"), ("01/05/2014", "01/01/2014"), ("junk", "01/01/2014"), ("01/01/2014", None)]
    days = fn.lead_time_days(F.col("o"), F.col("s"))
    rows = spark.createDataFrame([(i, *pair) for i, pair in enumerate(pairs)], "i int, o string, s string")
    assert [row.d for row in rows.select("i", days.alias("d")).orderBy("i").collect()] == [4, -4, None, None]


@pytest.mark.parametrize(
    ("values", "want"),
    [
        ([2.7, -2.7, 0.0, None], [2, -2, 0, None]),
        ([math.nan, 3e10, -3e10, math.inf, -math.inf], [None] * 5),
        ([2147483647.9, 2147483648.0, -2147483648.9, -2147483649.0], [2147483647, None, -2147483648, None]),
    ],
)
def test_int_from_double(spark, values, want):
    assert apply(spark, fn.to_int, values, "double") == want


def test_int_from_other_types(spark):
    assert apply(spark, fn.to_int, ["7", "x", None], "string") == [7, None, None]
    assert apply(spark, fn.to_int, [7, 2**40, None], "bigint") == [7, None, None]


def test_bigint(spark):
    assert apply(spark, fn.to_bigint, [2.7, 1e19, -1e19, math.nan, None], "double") == [2, None, None, None, None]
    assert apply(spark, fn.to_bigint, [2**63 - 1, -(2**63), None], "bigint") == [2**63 - 1, -(2**63), None]
    assert apply(spark, fn.to_bigint, [7, None], "int") == [7, None]


def test_bigint_at_the_edge(spark):
    assert apply(spark, fn.to_bigint, [2.0**63, -(2.0**63), 2.0**63 - 1024], "double") == [
        None,
        -(2**63),
        2**63 - 1024,
    ]
    edge = ["9223372036854775807", "9223372036854775808", "-9223372036854775808"]
    assert apply(spark, fn.to_bigint, edge, "string") == [2**63 - 1, None, -(2**63)]


def test_currency(spark):
    assert apply(spark, fn.convert_currency, [10.0, None], "double") == [830.0, None]
    assert apply(spark, lambda c: fn.convert_currency(c, 2), [10.0], "double") == [20.0]


def test_timestamps(spark):
    at = datetime.datetime(2024, 1, 2, 3, 4, 5, 600000)
    assert apply(spark, fn.to_text, [at, None], "timestamp_ntz") == ["2024-01-02 03:04:05.6", None]
    assert apply(spark, lambda c: fn.to_text(fn.to_timestamp(c)), [at], "timestamp_ntz") == ["2024-01-02 03:04:05.6"]
    assert apply(spark, fn.to_timestamp, ["junk"], "string") == [None]
