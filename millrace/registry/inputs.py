"""The jobs' inputs, mapped from the driver tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.sales import RAW_COLUMNS
from millrace.sources import read_parquet


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


# Priority codes of the order table; anything else passes through.
PRIORITY_CODES = {"1-URGENT": "C", "2-HIGH": "H", "3-MEDIUM": "M", "5-LOW": "L"}


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat sales rows: one per line item, all keys present."""
    buyers = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    lines = (
        table(spark, sf_dir, "lineitem")
        # Both sides grow with the data; without the hint a small data set broadcasts the line items.
        .join(buyers.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    priority = F.col("o_orderpriority")
    codes = F.coalesce(*[F.when(priority == text, code) for text, code in PRIORITY_CODES.items()], priority)
    return lines.select(
        F.col("r_name").alias("region"),
        F.col("n_name").alias("country"),
        F.col("p_type").alias("item_type"),
        F.when(F.col("l_returnflag") == "A", "Online").otherwise("Offline").alias("sales_channel"),
        codes.alias("order_priority"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("order_date"),
        F.col("o_orderkey").alias("order_id"),
        F.date_format("l_shipdate", "MM/dd/yyyy").alias("ship_date"),
        F.col("l_quantity").alias("units_sold"),
        F.col("p_retailprice").alias("unit_price"),
        (F.col("p_retailprice") * 0.5).alias("unit_cost"),
        F.col("l_extendedprice").alias("total_revenue"),
        (F.col("l_extendedprice") * 0.5).alias("total_cost"),
        (F.col("l_extendedprice") - F.col("l_extendedprice") * 0.5).alias("total_profit"),
    )


def sales_raw_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with missing keys and dates in other formats."""
    ship = F.col("ship_date")
    parsed = F.to_date(ship, "MM/dd/yyyy")
    return sales_raw(spark, sf_dir).withColumns(
        {
            "region": F.nullif("region", F.lit("ASIA")),
            "country": F.nullif("country", F.lit("NATION_7")),
            "item_type": F.nullif("item_type", F.lit("PROMO")),
            "order_priority": F.nullif("order_priority", F.lit("M")),
            "ship_date": F.when(F.col("sales_channel") == "Online", F.date_format(parsed, "yyyy-MM-dd"))
            .when(F.col("units_sold") > 45, F.date_format(parsed, "M/d/yyyy"))
            .when(F.col("units_sold") < 3, F.lit("unknown"))
            .otherwise(ship),
        }
    )


def sales_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat sales rows under the names an outside source uses."""
    return sales_raw(spark, sf_dir).withColumnsRenamed(RAW_COLUMNS)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxi trips from `events`: many share their pick-up hour and vendor, and no two columns are alike.

    Every fraction is exact in binary.
    """
    event, user = F.col("event_id"), F.col("user_id")
    events = table(spark, sf_dir, "events")
    kind = events.schema["ts"].dataType
    hour = F.date_trunc("hour", "ts").cast(kind)
    columns = {
        "tpep_pickup_datetime": F.when(event % 101 != 0, hour),
        "tpep_dropoff_datetime": F.when(event % 61 != 0, F.col("ts") + F.make_dt_interval(mins=(event % 97 + 1).cast("int"))),
        "VendorID": user % 20 + 0.25,
        "passenger_count": F.when(event % 50 != 0, event % 16 / 2),
        "trip_distance": F.col("value") / 16,
        "RatecodeID": event % 6 + 1.75,
        "payment_type": event % 4 + 1.5,
        "store_and_fwd_flag": F.when(F.col("event_type") == "error", "Y").when(event % 41 != 0, "N"),
        "PULocationID": event % 265 + 0.5,
        "DOLocationID": user % 265,
        "fare_amount": F.col("value"),
        "extra": event % 7 / 8,
        "mta_tax": event % 5 / 4 + 1,
        "tip_amount": F.when(event % 17 != 0, event % 11 / 2 + 2),
        "tolls_amount": event % 13 / 16 + 3,
        "improvement_surcharge": event % 19 / 32 + 4,
        "total_amount": F.when(event % 43 != 0, F.col("value") * 2 + event % 13),
        "congestion_surcharge": F.when(event % 29 != 0, event % 23 / 64 + 5),
        "__null_dask_index__": event,
    }
    return events.select(*[expr.alias(name) for name, expr in columns.items()])


LINE_TIE_BREAK = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def line_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pick-ups from `lineitem` and `orders`: many rows per pick-up time and vendor."""
    orders = table(spark, sf_dir, "orders").hint("merge")
    lines = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(
        F.col("o_orderdate").alias("pickup"),
        F.col("l_suppkey").alias("vendor"),
        F.col("l_linenumber").alias("payment_type"),
        *LINE_TIE_BREAK,
    )


def line_trips_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with no pick-up time for more than a third of the rows."""
    known = F.when(F.col("payment_type") > 3, F.col("pickup"))
    return line_trips(spark, sf_dir).withColumn("pickup", known)
