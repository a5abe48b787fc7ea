"""Taxi jobs: enrich trips, number them, split them into linked trip and payment tables.

Variant B is the scheduled job: payments get their own sequence and trips refer to it. Variant A
is the earlier one: payments refer to trips and timestamps are stored as text.
"""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import (
    DEFAULT_RATE,
    convert_currency,
    distance_length,
    passenger_load_exact,
    passenger_load_threshold,
    to_bigint,
    to_int,
    to_text,
    to_timestamp,
)
from millrace.operators import sequence_ids
from millrace.sources import read_parquet, run_stages, staged_job, write_parquet

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"

# Column lists of the output tables, in order.
PAYMENT_AMOUNTS = (
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
)
TRIP_FACTS = (
    "Trip_id",
    "VendorID",
    PICKUP,
    DROPOFF,
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "store_and_fwd_flag",
    "PULocationID",
    "DOLocationID",
)
# Columns that follow from one other output column.
FOLLOWING = ("Month", "Distance_Length", "trip_amt_INR")
INT_COLUMNS = ("VendorID", "passenger_count", "RatecodeID", "payment_type")
BIGINT_COLUMNS = ("PULocationID", "DOLocationID")


@dataclass(frozen=True)
class Variant:
    load: Callable[[Column], Column]
    store_timestamp: Callable[[Column], Column]
    orders: Mapping[str, Sequence[str]]
    twins: Mapping[str, str]  # ids equal to another id, row by row
    trip_columns: Sequence[str]
    payment_columns: Sequence[str]

    @property
    def output_columns(self) -> list[str]:
        return list(dict.fromkeys([*self.trip_columns, *self.payment_columns]))


VARIANT_A = Variant(
    load=passenger_load_exact,
    store_timestamp=to_text,
    orders={"Trip_id": (PICKUP, "VendorID")},
    twins={"Payment_id": "Trip_id"},
    trip_columns=(*TRIP_FACTS, "Month", "Distance_Length", "Car_utilization", "__null_dask_index__"),
    payment_columns=(
        "Payment_id",
        "Trip_id",
        *PAYMENT_AMOUNTS,
        "trip_amt_INR",
        "congestion_surcharge",
        "__null_dask_index__",
    ),
)
VARIANT_B = Variant(
    load=passenger_load_threshold,
    store_timestamp=to_timestamp,
    orders={"Trip_id": (PICKUP, "VendorID"), "Payment_id": (PICKUP, "payment_type")},
    twins={},
    trip_columns=(*TRIP_FACTS, "Payment_id", "Month", "Car_utilization", "Distance_Length", "trip_amt_INR"),
    payment_columns=("Payment_id", *PAYMENT_AMOUNTS, "congestion_surcharge"),
)
VARIANTS = {"a": VARIANT_A, "b": VARIANT_B}


class Split(NamedTuple):
    trip: DataFrame
    payment: DataFrame


def enrich(trips: DataFrame, variant: Variant = VARIANT_B, rate: float = DEFAULT_RATE) -> DataFrame:
    """Derived columns and casts in one projection; the buckets see the values before the casts."""
    return trips.withColumns(
        {
            "Month": F.month(PICKUP),
            "Car_utilization": variant.load(F.col("passenger_count")),
            "Distance_Length": distance_length(F.col("trip_distance")),
            "trip_amt_INR": convert_currency(F.col("total_amount"), rate),
            **{name: to_int(F.col(name)) for name in INT_COLUMNS},
            **{name: to_bigint(F.col(name)) for name in BIGINT_COLUMNS},
        }
    )


def number(
    trips: DataFrame, variant: Variant = VARIANT_B, tie_break: Sequence[str] | None = None, **options: int
) -> DataFrame:
    """Add the id columns; sorts and writes the output columns once per order.

    Ties are broken by `tie_break`, or else by all other output columns that do not follow from one
    another: then only rows that are equal throughout may swap ids. Both tables of a split see the same
    ids, as these are written.
    """
    if tie_break is None:
        tie_break = [name for name in variant.output_columns if name in trips.columns and name not in FOLLOWING]
    needed = [name for name in trips.columns if name in {*variant.output_columns, *tie_break}]
    trips = trips.select(*[f"`{name}`" for name in needed])
    orders = {name: list(dict.fromkeys([*keys, *tie_break])) for name, keys in variant.orders.items()}
    numbered = sequence_ids(trips, orders, **options)
    return numbered.withColumns({name: F.col(other) for name, other in variant.twins.items()})


def split(numbered: DataFrame, variant: Variant = VARIANT_B) -> Split:
    """Two projections of one numbered frame."""
    stored = numbered.withColumns({name: variant.store_timestamp(F.col(name)) for name in (PICKUP, DROPOFF)})
    return Split(stored.select(*variant.trip_columns), stored.select(*variant.payment_columns))


def transform(
    trips: DataFrame,
    variant: Variant = VARIANT_B,
    rate: float = DEFAULT_RATE,
    tie_break: Sequence[str] | None = None,
    **options: int,
) -> Split:
    """Trip and payment tables of the raw trips."""
    return split(number(enrich(trips, variant, rate), variant, tie_break, **options), variant)


# Names of the two warehouse tables.
TABLES = ("nyc_taxi_trip", "nyc_taxi_payment")

# Writes a frame to a named table, for example with `sources.write_connector`.
Save = Callable[[DataFrame, str], None]


def transform_and_load(
    spark: SparkSession, source: str, save: Save, tables: Sequence[str] = TABLES, **options: object
) -> None:
    """The scheduled job in one go: Parquet in, two warehouse tables out."""
    with staged_job(spark):
        for df, name in zip(transform(read_parquet(spark, source), **options), tables, strict=True):
            save(df, name)


def extract(spark: SparkSession, source: str, target: str) -> None:
    """Stage 1: copy the source to the work area."""
    write_parquet(read_parquet(spark, source), target)


def transform_files(
    spark: SparkSession,
    source: str,
    trip_path: str,
    payment_path: str,
    variant: Variant = VARIANT_A,
    **options: object,
) -> None:
    """Stage 2: extracted trips to a trip and a payment file set."""
    with staged_job(spark):
        tables = transform(read_parquet(spark, source), variant, **options)
        write_parquet(tables.trip, trip_path)
        write_parquet(tables.payment, payment_path)


def load(
    spark: SparkSession, trip_path: str, payment_path: str, save: Save, tables: Sequence[str] = TABLES
) -> None:
    """Stage 3: hand both file sets to the warehouse."""
    for path, name in zip((trip_path, payment_path), tables, strict=True):
        save(read_parquet(spark, path), name)


def staged_run(
    spark: SparkSession,
    source: str,
    work: str,
    run: str,
    save: Save,
    tables: Sequence[str] = TABLES,
    variant: Variant = VARIANT_A,
    **options: object,
) -> list[str]:
    """The three stages, with files and marks below `work`; returns the stages that ran. Called again with the same
    `run` it goes on behind the last stage, or the last table, that was finished. Ids come from the transformed files, so
    a load that is repeated hands on the same rows."""
    folder = f"{work.rstrip('/')}/{run}"
    extracted, *paths = (f"{folder}/{name}" for name in ("extracted", *TABLES))
    about = {"source": source, "variant": variant.trip_columns, **options}
    stages = {
        "extract": (lambda: extract(spark, source, extracted), {"source": source}),
        "transform": (lambda: transform_files(spark, extracted, *paths, variant, **options), about),
    }
    for path, name in zip(paths, tables, strict=True):
        stages[f"load_{name}"] = (lambda path=path, name=name: save(read_parquet(spark, path), name), about)
    return run_stages(spark, f"{work.rstrip('/')}/_marks", run, stages)
