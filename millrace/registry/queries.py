"""One query per operator and job: {key: (spark, sf_dir) -> DataFrame}."""

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import functions as fn
from millrace import operators as op
from millrace.plans import sales, taxi
from millrace.registry.inputs import (
    LINE_TIE_BREAK,
    line_trips,
    line_trips_hot,
    sales_raw,
    sales_raw_gaps,
    sales_source,
    table,
    trips,
)
from millrace.sources import (
    land_raw,
    publish_tables,
    read_parquet,
    read_parquet_widened,
    read_published,
    read_table,
    replace_table,
    stage,
    staging_path,
    write_connector,
    write_parquet,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _fresh_table(spark: SparkSession, label: str) -> tuple[str, str]:
    """Name and external path of a table no other run uses."""
    return f"{label}_{uuid4().hex}", staging_path(spark, label)


# Scans and sinks


@_query
def scan_parquet(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")


@_query
def sink_parquet_roundtrip(spark, sf_dir):
    path = staging_path(spark, "sink")
    write_parquet(table(spark, sf_dir, "customer"), path)
    write_parquet(table(spark, sf_dir, "orders"), path)
    return read_parquet(spark, path)


@_query
def sink_table_roundtrip(spark, sf_dir):
    """Two targets, each written twice; the built-in file connector stands in for a warehouse connector."""
    targets = {name: staging_path(spark, name) for name in ("orders_copy", "customer_copy")}
    for first, last, target in (("customer", "orders", "orders_copy"), ("orders", "customer", "customer_copy")):
        for name in (first, last):
            write_connector(table(spark, sf_dir, name), "parquet", target, {"path": targets[target]})
    orders, customer = (spark.read.format("parquet").load(path) for path in targets.values())
    both = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return both.select("o_orderkey", "c_custkey", "c_name", "o_orderdate")


@_query
def ctas_replace(spark, sf_dir):
    name, path = _fresh_table(spark, "ctas")
    raw = sales_raw(spark, sf_dir)
    replace_table(raw.select("region").distinct(), name, path)
    priority = fn.decode_labels(F.col("order_priority")).alias("priority")
    replace_table(raw.select("region", "country", priority), name, path)
    return spark.table(name)


@_query
def scan_table(spark, sf_dir):
    name, path = _fresh_table(spark, "SALES_DATA_RAW")
    replace_table(sales_source(spark, sf_dir), name, path)
    found = read_table(spark, "spark_catalog", spark.catalog.currentDatabase(), name)
    return found.select("REGION", "ITEM TYPE", "ORDER ID")


@_query
def raw_landing(spark, sf_dir):
    source = staging_path(spark, "source")
    sales_source(spark, sf_dir).write.option("header", True).csv(source)
    name, path = _fresh_table(spark, "raw")
    schema = sales_source(spark, sf_dir).schema
    return land_raw(spark, "csv", name, {"path": source, "header": "true"}, schema, path)


@_query
def scan_parquet_widened(spark, sf_dir):
    """Three files' worth of orders whose customer is int, bigint and double; one lacks the date."""
    path, key = staging_path(spark, "months"), F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders")
    for part, kind in enumerate(("int", "bigint", "double")):
        columns = ["o_orderkey", F.col("o_custkey").cast(kind).alias("o_custkey"), *(["o_orderdate"] if part else [])]
        orders.where(key % 3 == part).select(*columns).write.mode("append").parquet(path)
    return read_parquet_widened(spark, path).select("o_orderkey", "o_custkey", "o_orderdate")


def _landed_with_rejects(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as CSV, a seventh of them without a usable customer."""
    source, key = staging_path(spark, "source"), F.col("o_orderkey")
    customer = F.when(key % 7 == 0, "none").otherwise(F.col("o_custkey").cast("string"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    table(spark, sf_dir, "orders").select(key, customer, day).write.option("header", True).csv(source)
    (good, path), (bad, _) = (_fresh_table(spark, label) for label in ("landed", "rejects"))
    options, schema = {"path": source, "header": "true", "enforceSchema": "true"}, "`ORDER ID` bigint, Customer bigint, Day date"
    return land_raw(spark, "csv", good, options, schema, path, rejects=bad), spark.table(bad)


@_query
def raw_landing_fitting(spark, sf_dir):
    return _landed_with_rejects(spark, sf_dir)[0]


@_query
def raw_landing_rejected(spark, sf_dir):
    return _landed_with_rejects(spark, sf_dir)[1]


@_query
def publish_together(spark, sf_dir):
    """Two tables, published twice together, and read back by their version record."""
    root, mark = staging_path(spark, "published"), uuid4().hex
    names = {name: f"{name}_{mark}" for name in ("customer", "orders")}
    for rows in (1, None):
        frames = {names[name]: table(spark, sf_dir, name) for name in names}
        publish_tables({n: df.limit(rows) if rows else df for n, df in frames.items()}, spark.catalog.currentDatabase(), root)
    tables = read_published(spark, root)
    both = tables[names["orders"]].join(tables[names["customer"]], F.col("o_custkey") == F.col("c_custkey"))
    return both.select("o_orderkey", "c_custkey", "c_name", "o_orderdate")


# Projections and filters


@_query
def project_columns(spark, sf_dir):
    return trips(spark, sf_dir).select("VendorID", "tpep_pickup_datetime", "trip_distance", "total_amount")


@_query
def derive_columns(spark, sf_dir):
    return (
        trips(spark, sf_dir)
        .withColumns(
            {
                "Month": F.month("tpep_pickup_datetime"),
                "Distance_Length": fn.distance_length(F.col("trip_distance")),
                "total_amount": F.col("total_amount") + F.col("extra"),
            }
        )
        .select("__null_dask_index__", "Month", "Distance_Length", "total_amount")
    )


def _linked(spark: SparkSession, sf_dir: str) -> taxi.Split:
    numbered = taxi.number(taxi.enrich(trips(spark, sf_dir)))
    return taxi.Split(
        numbered.select("Trip_id", "VendorID", "trip_distance", "Payment_id"),
        numbered.select("Payment_id", "payment_type", "fare_amount", "total_amount"),
    )


@_query
def split_trip(spark, sf_dir):
    return _linked(spark, sf_dir).trip


@_query
def split_payment(spark, sf_dir):
    return _linked(spark, sf_dir).payment


@_query
def rename_columns(spark, sf_dir):
    source = sales_source(spark, sf_dir).select("ORDER ID", "ITEM TYPE")
    return source.withColumnsRenamed({"ITEM TYPE": "Item_type", "ORDER ID": "order_ref"})


@_query
def select_star_plus(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "*", F.when(F.col("o_orderstatus") == "F", "Final").otherwise(F.col("o_orderstatus")).alias("status_full")
    )


@_query
def filter_not_null(spark, sf_dir):
    rows = sales_raw_gaps(spark, sf_dir).select("order_id", "region", "item_type")
    return rows.where(F.col("region").isNotNull())


@_query
def filter_all_keys_present(spark, sf_dir):
    return op.keys_present(sales_raw_gaps(spark, sf_dir), sales.KEY_COLUMNS).select(*sales.KEY_COLUMNS)


@_query
def predicate_combos(spark, sf_dir):
    price, quantity, line = F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_linenumber")
    return (
        table(spark, sf_dir, "lineitem")
        .where(
            ((line == 1) | (line == 2))
            | ((quantity >= 5) & (quantity < 10))
            | ((quantity <= 2) & (price > 1000))
        )
        .select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    )


@_query
def derived_table(spark, sf_dir):
    inner = table(spark, sf_dir, "customer").where(F.col("c_mktsegment").isNotNull()).select("c_mktsegment").distinct()
    return inner.select(F.upper("c_mktsegment").alias("segment"), F.length("c_mktsegment").alias("width"))


@_query
def drop_column(spark, sf_dir):
    return trips(spark, sf_dir).drop("__null_dask_index__")


# Scalar functions


def _event(spark: SparkSession, sf_dir: str, *columns: Column) -> DataFrame:
    return trips(spark, sf_dir).select(F.col("__null_dask_index__").alias("event_id"), *columns)


@_query
def month_of_ts(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.month("o_orderdate").alias("month"))


@_query
def bucket_equality(spark, sf_dir):
    return _event(spark, sf_dir, fn.passenger_load_exact(F.col("passenger_count")).alias("load"))


@_query
def bucket_threshold(spark, sf_dir):
    return _event(spark, sf_dir, fn.passenger_load_threshold(F.col("passenger_count")).alias("load"))


@_query
def bucket_half_open(spark, sf_dir):
    return _event(spark, sf_dir, fn.distance_length(F.col("trip_distance")).alias("distance"))


def _decoded(raw: DataFrame) -> DataFrame:
    return raw.select("order_id", fn.decode_labels(F.col("order_priority")).alias("priority"))


@_query
def decode_labels(spark, sf_dir):
    return _decoded(sales_raw_gaps(spark, sf_dir))


@_query
def convert_currency(spark, sf_dir):
    amount = F.col("total_amount")
    return _event(
        spark,
        sf_dir,
        fn.convert_currency(amount).alias("at_default"),
        fn.convert_currency(amount, 85.25).alias("at_rate"),
    )


@_query
def cast_int(spark, sf_dir):
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        fn.to_int(price / 8).alias("price_int"),
        fn.to_int(-price / 8).alias("negative_int"),
        fn.to_int(price * 1_000_000).alias("overflow_int"),
    )


@_query
def cast_bigint(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        fn.to_bigint(F.col("l_linenumber")).alias("line_bigint"),
        fn.to_bigint(F.col("l_extendedprice") * 1_000_000).alias("price_bigint"),
    )


@_query
def cast_timestamp(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", fn.to_timestamp(F.col("ts")).alias("at"))


@_query
def timestamp_to_string(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", fn.to_text(F.col("ts")).alias("at"))


@_query
def try_parse_date(spark, sf_dir):
    return sales_raw_gaps(spark, sf_dir).select(
        "order_id", "ship_date", fn.parse_date(F.col("ship_date")).alias("shipped")
    )


@_query
def parse_date_multi(spark, sf_dir):
    return sales_raw_gaps(spark, sf_dir).select(
        "order_id", "ship_date", fn.parse_date(F.col("ship_date"), fn.LENIENT_DATES).alias("shipped")
    )


@_query
def lead_time_days(spark, sf_dir):
    days = fn.lead_time_days(F.col("order_date"), F.col("ship_date"))
    return sales_raw(spark, sf_dir).select("order_id", "order_date", "ship_date", days.alias("days"))


@_query
def explode_delimited(spark, sf_dir):
    return op.explode_delimited(table(spark, sf_dir, "part"), "p_name", " ")


@_query
def explode_text_lines(spark, sf_dir):
    """Whole texts as lists: every line of every document."""
    return op.explode_delimited(table(spark, sf_dir, "documents"), "text", "\n", "line")


# Distinct


@_query
def distinct_column(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_type").distinct()


@_query
def distinct_expression(spark, sf_dir):
    return _decoded(sales_raw(spark, sf_dir)).select("priority").distinct()


@_query
def count_distinct_items(spark, sf_dir):
    return op.count_distinct_items(table(spark, sf_dir, "part"), "p_name", " ")


# Surrogate keys and sequences. The numbering passes over its input several times, so a join is staged first.


@_query
def dim_surrogate_key(spark, sf_dir):
    return op.dimension(table(spark, sf_dir, "part"), "Name_id", "p_name", F.col("p_name"))


@_query
def sequence_global(spark, sf_dir):
    order = ["pickup", "vendor", *LINE_TIE_BREAK]
    return op.sequence_id(stage(line_trips(spark, sf_dir)), "Trip_id", order).select("Trip_id", *LINE_TIE_BREAK)


@_query
def sequence_second_order(spark, sf_dir):
    orders = {
        "Trip_id": ["pickup", "vendor", *LINE_TIE_BREAK],
        "Payment_id": ["pickup", "payment_type", *LINE_TIE_BREAK],
    }
    return op.sequence_ids(stage(line_trips(spark, sf_dir)), orders).select("Trip_id", "Payment_id", *LINE_TIE_BREAK)


@_query
def sequence_twin(spark, sf_dir):
    numbered = taxi.number(taxi.enrich(trips(spark, sf_dir), taxi.VARIANT_A), taxi.VARIANT_A)
    return numbered.select("Trip_id", "Payment_id", "__null_dask_index__")


@_query
def sequence_hot_key(spark, sf_dir):
    """Both orders where one missing pick-up time fills more than a third of the rows."""
    orders = {
        "Trip_id": ["pickup", "vendor", *LINE_TIE_BREAK],
        "Payment_id": ["pickup", "payment_type", *LINE_TIE_BREAK],
    }
    hot = op.sequence_ids(stage(line_trips_hot(spark, sf_dir)), orders, rows_per_task=5_000)
    return hot.select("Trip_id", "Payment_id", *LINE_TIE_BREAK)


@_query
def sequence_ties(spark, sf_dir):
    """Many rows are equal in the whole order; any of them may have either id."""
    lines = stage(line_trips(spark, sf_dir).select("pickup", "vendor"))
    return op.sequence_id(lines, "Trip_id", ["pickup", "vendor"])


@_query
def dim_surrogate_key_large(spark, sf_dir):
    """Numbered by many tasks."""
    values = stage(table(spark, sf_dir, "customer").select("c_name").distinct())
    return op.surrogate_key(values, "c_name", "Name_id", one_task_rows=100)


# Joins


def _skewed_lines(spark, sf_dir):
    """Lines of which one customer has more than half, and all customers with a number."""
    customer = F.when(F.col("payment_type") > 2, F.lit(-1).cast("bigint")).otherwise(F.col("o_custkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = line_trips(spark, sf_dir).join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    fact = lines.select(customer.alias("customer"), "l_orderkey", "l_linenumber")
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer"), (F.col("c_custkey") * 2).alias("rank"))
    hot = spark.range(1).select(F.lit(-1).cast("bigint").alias("customer"), F.lit(0).cast("bigint").alias("rank"))
    return fact, known.unionByName(hot)


@_query
def join_lookup_large(spark, sf_dir):
    """Both sides shuffled."""
    fact, customers = _skewed_lines(spark, sf_dir)
    return op.join_lookup(stage(fact), customers, "customer", max_rows=0)


@_query
def join_lookup_split(spark, sf_dir):
    """The hot customer's lines meet a broadcast row, the others are shuffled."""
    fact, customers = _skewed_lines(spark, sf_dir)
    return op.join_lookup_split(stage(fact), stage(customers), "customer")


@_query
def join_fact_dim(spark, sf_dir):
    raw = stage(sales_raw(spark, sf_dir).select("order_id", "country"))
    return op.join_lookup(raw, op.dimension(raw, "Country_id", "country", F.col("country")), "country")


@_query
def join_computed_key(spark, sf_dir):
    raw = stage(sales_raw(spark, sf_dir).select("order_id", "order_priority"))
    decoded = fn.decode_labels(F.col("order_priority"))
    dim = op.dimension(raw, "OrderPriority_id", "ORDER_PRIORITY_FULL", decoded)
    return op.join_lookup(raw.withColumn("ORDER_PRIORITY_FULL", decoded), dim, "ORDER_PRIORITY_FULL")


@_query
def star_fact(spark, sf_dir):
    raw = stage(sales_raw_gaps(spark, sf_dir))
    return sales.star_fact(raw, sales.star_dimensions(raw))


@_query
def star_fact_shuffled(spark, sf_dir):
    """No dimension is broadcast; a region has a fifth of the rows."""
    raw = stage(sales_raw_gaps(spark, sf_dir))
    return sales.star_fact(raw, sales.star_dimensions(raw), max_broadcast_rows=0)


# Jobs


@_query
def taxi_b_trip(spark, sf_dir):
    return taxi.transform(trips(spark, sf_dir), taxi.VARIANT_B).trip


@_query
def taxi_b_payment(spark, sf_dir):
    return taxi.transform(trips(spark, sf_dir), taxi.VARIANT_B).payment


@_query
def taxi_a_trip(spark, sf_dir):
    return taxi.transform(trips(spark, sf_dir), taxi.VARIANT_A).trip


@_query
def taxi_a_payment(spark, sf_dir):
    return taxi.transform(trips(spark, sf_dir), taxi.VARIANT_A).payment


@_query
def taxi_staged(spark, sf_dir):
    """Extract, transform and load with files between, then the two tables joined again."""
    source, extracted, trip_path, payment_path = (
        staging_path(spark, label) for label in ("source", "extracted", "trip", "payment")
    )
    write_parquet(trips(spark, sf_dir), source)
    taxi.extract(spark, source, extracted)
    taxi.transform_files(spark, extracted, trip_path, payment_path)
    targets = {}

    def save(df: DataFrame, name: str) -> None:
        targets[name] = _fresh_table(spark, name)
        replace_table(df, *targets[name])

    taxi.load(spark, trip_path, payment_path, save)
    trip, payment = (spark.table(name) for name, _ in targets.values())
    return trip.join(payment.drop("__null_dask_index__"), "Trip_id").select(
        "Trip_id", "Payment_id", "VendorID", "Car_utilization", "trip_amt_INR", "__null_dask_index__"
    )


@_query
def taxi_restarted(spark, sf_dir):
    """A staged run whose second load fails, and the same run again; then the two tables joined."""
    source, work = staging_path(spark, "source"), staging_path(spark, "work")
    write_parquet(trips(spark, sf_dir), source)
    targets, broken = {}, [True]

    def save(df: DataFrame, name: str) -> None:
        if name == taxi.TABLES[1] and broken:
            broken.clear()
            raise ConnectionError("the warehouse is away")
        targets[name] = _fresh_table(spark, name)
        replace_table(df, *targets[name])

    for _ in range(2):
        try:
            taxi.staged_run(spark, source, work, "run", save)
        except ConnectionError:
            continue
    trip, payment = (spark.table(targets[name][0]) for name in taxi.TABLES)
    return trip.join(payment.drop("__null_dask_index__"), "Trip_id").select(
        "Trip_id", "Payment_id", "VendorID", "Car_utilization", "trip_amt_INR", "__null_dask_index__"
    )


@_query
def taxi_transform_and_load(spark, sf_dir):
    """The scheduled job through connector writes, then the two tables joined again."""
    source = staging_path(spark, "source")
    write_parquet(trips(spark, sf_dir), source)
    paths = {name: staging_path(spark, name) for name in taxi.TABLES}

    def save(df: DataFrame, name: str) -> None:
        write_connector(df, "parquet", name, {"path": paths[name]})

    taxi.transform_and_load(spark, source, save)
    trip, payment = (read_parquet(spark, path) for path in paths.values())
    return trip.join(payment, "Payment_id").select(
        "Trip_id", "Payment_id", "VendorID", "payment_type", "Car_utilization", "trip_amt_INR"
    )


def _star_dim(id_name: str, raw=sales_raw) -> Query:
    return lambda spark, sf_dir: sales.star_dimension(raw(spark, sf_dir), id_name)


QUERIES["dim_region"] = _star_dim("Region_id")
QUERIES["dim_country"] = _star_dim("Country_id")
QUERIES["dim_item"] = _star_dim("Item_id")
QUERIES["dim_priority"] = _star_dim("OrderPriority_id")
QUERIES["dim_item_gaps"] = _star_dim("Item_id", sales_raw_gaps)


@_query
def sales_star(spark, sf_dir):
    return sales.star(stage(sales_raw(spark, sf_dir))).orders


@_query
def sales_star_raw_priority(spark, sf_dir):
    return sales.star(stage(sales_raw_gaps(spark, sf_dir)), sales.RAW_PRIORITY).orders


@_query
def sales_flat(spark, sf_dir):
    return sales.flat(sales_raw(spark, sf_dir))


@_query
def sales_flat_named(spark, sf_dir):
    return sales.flat(sales_raw_gaps(spark, sf_dir), "ORDER_PRIORITY")


@_query
def sales_flat_in_place(spark, sf_dir):
    return sales.flat(sales_raw_gaps(spark, sf_dir), None)


@_query
def sales_star_published(spark, sf_dir):
    """All five tables published together, and the fact read back by the version record."""
    database, root = f"star_{uuid4().hex}", staging_path(spark, "star")
    spark.sql(f"CREATE DATABASE {database}")
    sales.write_star(sales.star(stage(sales_raw(spark, sf_dir))), database, root)
    return read_published(spark, root)["Orders"]
