"""Sales jobs: flat rows to a star schema, or to one flat table.

Input columns are the normalized names of the raw table (see `sources.normalize_names`); output
columns carry the warehouse names.
"""

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import LENIENT_DATES, STRICT_DATES, decode_labels, lead_time_days
from millrace.operators import BROADCAST_ROWS, dimension, dimensions, fit_broadcast, join_lookup, keys_present
from millrace.sources import publish_tables

# Warehouse names and column order of the sales tables.
RAW_COLUMNS = {
    "region": "REGION",
    "country": "COUNTRY",
    "item_type": "ITEM TYPE",
    "sales_channel": "SALES CHANNEL",
    "order_priority": "ORDER PRIORITY",
    "order_date": "ORDER DATE",
    "order_id": "ORDER ID",
    "ship_date": "SHIP DATE",
    "units_sold": "UNITS SOLD",
    "unit_price": "UNIT PRICE",
    "unit_cost": "UNIT COST",
    "total_revenue": "TOTAL REVENUE",
    "total_cost": "TOTAL COST",
    "total_profit": "TOTAL PROFIT",
}
FACT_COLUMNS = (
    "order_id",
    "item_type",
    "ship_date",
    "unit_cost",
    "order_date",
    "total_cost",
    "unit_price",
    "units_sold",
    "total_profit",
    "sales_channel",
    "total_revenue",
)
RAW_PRIORITY_FACT_COLUMNS = (
    "sales_channel",
    "order_date",
    "order_id",
    "ship_date",
    "units_sold",
    "unit_price",
    "unit_cost",
    "total_revenue",
    "total_cost",
    "total_profit",
)
KEY_COLUMNS = ("order_id", "item_type", "region", "country", "order_priority")
LEAD_TIME = "SHIPMENT_LEAD_TIME"


class Star(NamedTuple):
    region: DataFrame
    country: DataFrame
    item: DataFrame
    order_priority: DataFrame
    orders: DataFrame


TABLE_NAMES = ("Region", "Country", "Item", "Order_Priority", "Orders")


class Form(NamedTuple):
    """What differs between the current star and the one it replaced."""

    columns: Sequence[str]
    names: Mapping[str, str]
    decode: bool
    date_patterns: Sequence[str]
    required: Sequence[str]


CURRENT = Form(FACT_COLUMNS, RAW_COLUMNS, decode=True, date_patterns=STRICT_DATES, required=KEY_COLUMNS)
# Raw priority codes as labels, several date patterns, and a dimension row for a missing value.
RAW_PRIORITY = Form(
    RAW_PRIORITY_FACT_COLUMNS,
    {name: name.upper() for name in RAW_COLUMNS},
    decode=False,
    date_patterns=LENIENT_DATES,
    required=(),
)


def _keys(form: Form) -> dict[str, tuple[str, Column]]:
    """{id name: (value name, expression)}; dimension and fact must use the same expression."""
    priority = F.col("order_priority")
    return {
        "Region_id": ("REGION", F.col("region")),
        "Country_id": ("COUNTRY", F.col("country")),
        "Item_id": ("Item_type", F.col("item_type")),
        "OrderPriority_id": ("ORDER_PRIORITY", decode_labels(priority) if form.decode else priority),
    }


def star_dimensions(raw: DataFrame, form: Form = CURRENT) -> dict[str, DataFrame]:
    """The four dimensions by id name."""
    return dimensions(raw, _keys(form), keep_null=not form.required)


def star_dimension(raw: DataFrame, id_name: str, form: Form = CURRENT) -> DataFrame:
    """One of the four dimensions."""
    return dimension(raw, id_name, *_keys(form)[id_name], keep_null=not form.required)


def star_fact(
    raw: DataFrame,
    dims: Mapping[str, DataFrame],
    form: Form = CURRENT,
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Replace the text keys by ids. A row that lacks a key is left out."""
    keys = _keys(form)
    lead_time = lead_time_days(F.col("order_date"), F.col("ship_date"), form.date_patterns)
    source = keys_present(raw, form.required).select(
        *[F.col(name).alias(form.names[name]) for name in form.columns],
        *[expr.alias(f"_{id_name}") for id_name, (_, expr) in keys.items()],
        lead_time.alias(LEAD_TIME),
    )
    fact = source
    # All dimensions are measured in one job.
    for id_name, small in zip(keys, fit_broadcast([dims[id_name] for id_name in keys], max_broadcast_rows)):
        dim = dims[id_name].toDF(id_name, f"_{id_name}")
        fact = join_lookup(fact, dim, f"_{id_name}", small=small, keys=source)
    return fact.select(*[f"`{form.names[name]}`" for name in form.columns], *keys, LEAD_TIME)


def star(raw: DataFrame, form: Form = CURRENT, date_patterns: Sequence[str] | None = None) -> Star:
    """Four dimensions and the fact that refers to them; `date_patterns` replaces the form's own.

    Reads `raw` once per dimension, a column at a time, and once for the fact: land or `stage` it
    first unless it is a table.
    """
    if date_patterns is not None:
        form = form._replace(date_patterns=date_patterns)
    dims = star_dimensions(raw, form)
    return Star(*dims.values(), star_fact(raw, dims, form))


def write_star(tables: Star, database: str | Sequence[str], path: str | None = None) -> None:
    """Replace the five tables together, with their versions and the version record below `path`.

    `database` may have several parts, such as a catalog and a schema. Without a path the versions go to the
    database's folder. A catalog other than the session's is handed the tables one by one.
    """
    frames = dict(zip(TABLE_NAMES, tables, strict=True))
    publish_tables(frames, database, path)


def flat(raw: DataFrame, label: str | None = "ORDER_PRIORITY_DESC") -> DataFrame:
    """All raw columns with the decoded priority and the lead time.

    The decoded text goes to a column named `label`, or replaces the code when `label` is None.
    """
    decoded = decode_labels(F.col("order_priority"))
    columns = {name: F.col(name) for name in RAW_COLUMNS}
    if label is None:
        columns["order_priority"] = decoded
    lead_time = lead_time_days(F.col("order_date"), F.col("ship_date"), LENIENT_DATES)
    return raw.select(
        *[expr.alias(RAW_COLUMNS[name]) for name, expr in columns.items()],
        *([] if label is None else [decoded.alias(label)]),
        lead_time.alias(LEAD_TIME),
    )
