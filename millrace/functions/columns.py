"""Column builders. All are built-in expressions, so they stay inside generated code."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels, codes, bounds, patterns and the default rate that results must agree on.
PRIORITY_LABELS = {"H": "High", "L": "Low", "M": "Medium", "C": "Cold"}
DISTANCE_BANDS = [("Short", 1, 5), ("Medium", 5, 10), ("Long", 10, None)]
STRICT_DATES = ("MM/dd/yyyy",)
LENIENT_DATES = ("M/d/yyyy", "MM/dd/yyyy", "yyyy-MM-dd")
DEFAULT_RATE = 83.0
UNKNOWN = "Unknown"


def _first_match(cases: Sequence[tuple[Column, str]], default: Column) -> Column:
    """CASE over (condition, label); a NULL condition does not match."""
    (condition, label), *rest = cases
    case = reduce(lambda acc, c: acc.when(c[0], F.lit(c[1])), rest, F.when(condition, F.lit(label)))
    return case.otherwise(default)


def label_equal(
    col: Column, sets: Mapping[str, Sequence[float]], above: tuple[str, float], default: str = UNKNOWN
) -> Column:
    """Label by membership in a set of values, then by exceeding one bound."""
    cases = [(col.isin(*values), label) for label, values in sets.items()]
    return _first_match([*cases, (col > above[1], above[0])], F.lit(default))


def label_up_to(
    col: Column, bounds: Sequence[tuple[str, float]], above: str, default: str = UNKNOWN
) -> Column:
    """Label by the first inclusive upper bound that holds; `above` for larger values."""
    cases = [(col <= bound, label) for label, bound in bounds]
    return _first_match([*cases, (col > bounds[-1][1], above)], F.lit(default))


def label_ranges(
    col: Column, ranges: Sequence[tuple[str, float, float | None]], default: str = UNKNOWN
) -> Column:
    """Label by half-open range [low, high); a missing high bound is open."""
    cases = [
        (col >= low if high is None else (col >= low) & (col < high), label)
        for label, low, high in ranges
    ]
    return _first_match(cases, F.lit(default))


def passenger_load_exact(col: Column) -> Column:
    """1 or 2 is Low, 3 or 4 is Medium, above 4 is Full; fractions and zero are Unknown."""
    return label_equal(col, {"Low": (1, 2), "Medium": (3, 4)}, above=("Full", 4))


def passenger_load_threshold(col: Column) -> Column:
    """Up to 2 is Low, up to 4 is Medium, above 4 is Full; only NULL is Unknown."""
    return label_up_to(col, [("Low", 2), ("Medium", 4)], above="Full")


def distance_length(col: Column) -> Column:
    return label_ranges(col, DISTANCE_BANDS)


def decode_labels(col: Column, labels: Mapping[str, str] = PRIORITY_LABELS) -> Column:
    """Replace known codes by their label; anything else, NULL included, passes through."""
    return _first_match([(col == code, label) for code, label in labels.items()], col)


def convert_currency(amount: Column, rate: float = DEFAULT_RATE) -> Column:
    return amount * F.lit(float(rate))


def _try_integer(col: Column, kind: str, limit: float) -> Column:
    """Truncating cast, NULL from `limit` on: a failing cast costs many times the comparison."""
    number = col.try_cast("double")
    fits = (number > -limit - 1) & (number < limit) | (number == -limit)
    # A double cannot tell the largest integer from the limit.
    largest = (number == limit) & (col.try_cast("decimal(38,0)") < F.lit(str(int(limit))).cast("decimal(38,0)"))
    return F.when(fits | largest, col.try_cast(kind))


def to_int(col: Column) -> Column:
    """Truncating cast; NULL where the value does not fit."""
    return _try_integer(col, "int", 2.0**31)


def to_bigint(col: Column) -> Column:
    """Truncating cast; NULL where the value does not fit."""
    return _try_integer(col, "bigint", 2.0**63)


def to_timestamp(col: Column) -> Column:
    return col.try_cast("timestamp")


def to_text(col: Column) -> Column:
    return col.cast("string")


def _try_pattern(col: Column, pattern: str) -> Column:
    """Text without a separator of the pattern is not tried: a failing parse costs several good ones."""
    possible = [F.contains(col, F.lit(mark)) for mark in "/-." if mark in pattern]
    parsed = F.try_to_date(col, pattern)
    return F.when(reduce(Column.__and__, possible), parsed) if possible else parsed


def parse_date(col: Column, patterns: Sequence[str] = STRICT_DATES) -> Column:
    """First pattern that parses the text, NULL when none does."""
    return F.coalesce(*[_try_pattern(col, pattern) for pattern in patterns])


def lead_time_days(ordered: Column, shipped: Column, patterns: Sequence[str] = STRICT_DATES) -> Column:
    """Whole days from order to shipment, negative when shipped first."""
    return F.date_diff(parse_date(shipped, patterns), parse_date(ordered, patterns))
