"""The SQL each query must agree with, over the same tables."""

_PRIORITY_CODE = """CASE o_orderpriority WHEN '1-URGENT' THEN 'C' WHEN '2-HIGH' THEN 'H'
    WHEN '3-MEDIUM' THEN 'M' WHEN '5-LOW' THEN 'L' ELSE o_orderpriority END"""

_SALES = f"""sales AS (
  SELECT r_name AS region, n_name AS country, p_type AS item_type,
    CASE WHEN l_returnflag = 'A' THEN 'Online' ELSE 'Offline' END AS sales_channel,
    {_PRIORITY_CODE} AS order_priority,
    strftime(o_orderdate, '%m/%d/%Y') AS order_date, o_orderkey AS order_id,
    strftime(l_shipdate, '%m/%d/%Y') AS ship_date,
    l_quantity AS units_sold, p_retailprice AS unit_price, p_retailprice * 0.5::DOUBLE AS unit_cost,
    l_extendedprice AS total_revenue, l_extendedprice * 0.5::DOUBLE AS total_cost,
    l_extendedprice - l_extendedprice * 0.5::DOUBLE AS total_profit
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey)"""

_GAPS = f"""{_SALES}, gaps AS (
  SELECT * REPLACE (
    nullif(region, 'ASIA') AS region, nullif(country, 'NATION_7') AS country,
    nullif(item_type, 'PROMO') AS item_type, nullif(order_priority, 'M') AS order_priority,
    CASE WHEN sales_channel = 'Online' THEN strftime(strptime(ship_date, '%m/%d/%Y'), '%Y-%m-%d')
      WHEN units_sold > 45 THEN strftime(strptime(ship_date, '%m/%d/%Y'), '%-m/%-d/%Y')
      WHEN units_sold < 3 THEN 'unknown' ELSE ship_date END AS ship_date)
  FROM sales)"""


def _decode(column: str) -> str:
    return f"""CASE {column} WHEN 'H' THEN 'High' WHEN 'L' THEN 'Low' WHEN 'M' THEN 'Medium' WHEN 'C' THEN 'Cold'
      ELSE {column} END"""


def _strict(column: str) -> str:
    """Padded text only, which the engine's own pattern does not insist on."""
    padded = f"regexp_full_match({column}, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}')"
    return f"CASE WHEN {padded} THEN CAST(try_strptime({column}, '%m/%d/%Y') AS DATE) END"


def _lenient(column: str) -> str:
    return f"CAST(coalesce(try_strptime({column}, '%m/%d/%Y'), try_strptime({column}, '%Y-%m-%d')) AS DATE)"


def _days(parse, start: str = "order_date", end: str = "ship_date") -> str:
    return f"CAST(date_diff('day', {parse(start)}, {parse(end)}) AS INTEGER)"


_KEYS_PRESENT = """order_id IS NOT NULL AND item_type IS NOT NULL AND region IS NOT NULL
    AND country IS NOT NULL AND order_priority IS NOT NULL"""


def _dim(source: str, expr: str, id_name: str, value: str, keep_null: bool = False) -> str:
    known = "" if keep_null else f"WHERE {expr} IS NOT NULL"
    return f"""SELECT row_number() OVER (ORDER BY v NULLS LAST) AS "{id_name}", v AS "{value}"
      FROM (SELECT DISTINCT {expr} AS v FROM {source} {known})"""


def _dims(source: str, decode: bool, keep_null: bool = False) -> str:
    priority = _decode("order_priority") if decode else "order_priority"
    return f"""r AS ({_dim(source, 'region', 'Region_id', 'k', keep_null)}),
      c AS ({_dim(source, 'country', 'Country_id', 'k', keep_null)}),
      i AS ({_dim(source, 'item_type', 'Item_id', 'k', keep_null)}),
      p AS ({_dim(source, priority, 'OrderPriority_id', 'k', keep_null)})"""


def _fact(rows: str, source: str) -> str:
    return f"""WITH {rows}, {_dims(source, decode=True)}
    SELECT order_id AS "ORDER ID", item_type AS "ITEM TYPE", ship_date AS "SHIP DATE", unit_cost AS "UNIT COST",
      order_date AS "ORDER DATE", total_cost AS "TOTAL COST", unit_price AS "UNIT PRICE",
      units_sold AS "UNITS SOLD", total_profit AS "TOTAL PROFIT", sales_channel AS "SALES CHANNEL",
      total_revenue AS "TOTAL REVENUE", "Region_id", "Country_id", "Item_id", "OrderPriority_id",
      {_days(_strict)} AS "SHIPMENT_LEAD_TIME"
    FROM (SELECT *, {_decode('order_priority')} AS priority FROM {source} WHERE {_KEYS_PRESENT}) s
      JOIN r ON r.k = s.region JOIN c ON c.k = s.country JOIN i ON i.k = s.item_type JOIN p ON p.k = s.priority"""


def _flat(rows: str, source: str, priority: str, label: str | None) -> str:
    decoded = f'{_decode("order_priority")} AS "{label}",' if label else ""
    return f"""WITH {rows}
    SELECT region AS "REGION", country AS "COUNTRY", item_type AS "ITEM TYPE", sales_channel AS "SALES CHANNEL",
      {priority} AS "ORDER PRIORITY", order_date AS "ORDER DATE", order_id AS "ORDER ID",
      ship_date AS "SHIP DATE", units_sold AS "UNITS SOLD", unit_price AS "UNIT PRICE", unit_cost AS "UNIT COST",
      total_revenue AS "TOTAL REVENUE", total_cost AS "TOTAL COST", total_profit AS "TOTAL PROFIT",
      {decoded} {_days(_lenient)} AS "SHIPMENT_LEAD_TIME"
    FROM {source}"""


_TRIPS = """trips AS (
  SELECT CASE WHEN event_id % 101 <> 0 THEN date_trunc('hour', ts) END AS tpep_pickup_datetime,
    CASE WHEN event_id % 61 <> 0 THEN ts + to_minutes(event_id % 97 + 1) END AS tpep_dropoff_datetime,
    user_id % 20 + 0.25::DOUBLE AS "VendorID",
    CASE WHEN event_id % 50 <> 0 THEN (event_id % 16) / 2 END AS passenger_count,
    value / 16 AS trip_distance, event_id % 6 + 1.75::DOUBLE AS "RatecodeID",
    event_id % 4 + 1.5::DOUBLE AS payment_type,
    CASE WHEN event_type = 'error' THEN 'Y' WHEN event_id % 41 <> 0 THEN 'N' END AS store_and_fwd_flag,
    event_id % 265 + 0.5::DOUBLE AS "PULocationID", user_id % 265 AS "DOLocationID", value AS fare_amount,
    (event_id % 7) / 8 AS extra, (event_id % 5) / 4 + 1 AS mta_tax,
    CASE WHEN event_id % 17 <> 0 THEN (event_id % 11) / 2 + 2 END AS tip_amount,
    (event_id % 13) / 16 + 3 AS tolls_amount, (event_id % 19) / 32 + 4 AS improvement_surcharge,
    CASE WHEN event_id % 43 <> 0 THEN value * 2 + event_id % 13 END AS total_amount,
    CASE WHEN event_id % 29 <> 0 THEN (event_id % 23) / 64 + 5 END AS congestion_surcharge,
    event_id AS "__null_dask_index__"
  FROM events)"""

_LOAD_EXACT = """CASE WHEN passenger_count IN (1, 2) THEN 'Low' WHEN passenger_count IN (3, 4) THEN 'Medium'
    WHEN passenger_count > 4 THEN 'Full' ELSE 'Unknown' END"""
_LOAD_THRESHOLD = """CASE WHEN passenger_count <= 2 THEN 'Low' WHEN passenger_count <= 4 THEN 'Medium'
    WHEN passenger_count > 4 THEN 'Full' ELSE 'Unknown' END"""
_DISTANCE = """CASE WHEN trip_distance >= 1 AND trip_distance < 5 THEN 'Short'
    WHEN trip_distance >= 5 AND trip_distance < 10 THEN 'Medium'
    WHEN trip_distance >= 10 THEN 'Long' ELSE 'Unknown' END"""


def _int(column: str, kind: str = "INTEGER") -> str:
    return f"TRY_CAST(trunc({column}) AS {kind})"


# Ties go by the output columns, in their order.
_PAID = """payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
    total_amount, congestion_surcharge"""
_DRIVEN = """"VendorID", tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, "RatecodeID",
    store_and_fwd_flag, "PULocationID", "DOLocationID\""""


def _numbered(first: str, tie: str) -> str:
    """The numbering by pick-up time and one further column."""
    names = ["tpep_pickup_datetime", first, *[name.strip() for name in tie.split(",")]]
    return f"row_number() OVER (ORDER BY {', '.join(f'{name} NULLS FIRST' for name in names)})"


_NUMBERED = f"""{_TRIPS}, enriched AS (
  SELECT * REPLACE (
      {_int('"VendorID"')} AS "VendorID", {_int('passenger_count')} AS passenger_count,
      {_int('"RatecodeID"')} AS "RatecodeID", {_int('payment_type')} AS payment_type,
      {_int('"PULocationID"', 'BIGINT')} AS "PULocationID"),
    CAST(month(tpep_pickup_datetime) AS INTEGER) AS "Month",
    {_LOAD_EXACT} AS load_exact, {_LOAD_THRESHOLD} AS load_threshold, {_DISTANCE} AS "Distance_Length",
    total_amount * 83.0::DOUBLE AS "trip_amt_INR"
  FROM trips
), numbered AS (
  SELECT *, {_numbered('"VendorID"', f"{_DRIVEN}, load_exact, __null_dask_index__")} AS trip_id_a,
    {_numbered('"VendorID"', f"{_DRIVEN}, load_threshold, {_PAID}")} AS "Trip_id",
    {_numbered('payment_type', f"{_DRIVEN}, load_threshold, {_PAID}")} AS "Payment_id"
  FROM enriched)"""

_AMOUNTS = """payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
    total_amount, congestion_surcharge"""
_PLACES = """passenger_count, trip_distance, "RatecodeID", store_and_fwd_flag, "PULocationID", "DOLocationID" """

_TIE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def _sequences(pickup: str, second: bool) -> str:
    payment = f"row_number() OVER (ORDER BY p NULLS FIRST, l_linenumber, {_TIE}) AS \"Payment_id\"," if second else ""
    return f"""SELECT row_number() OVER (ORDER BY p NULLS FIRST, l_suppkey, {_TIE}) AS "Trip_id", {payment} {_TIE}
      FROM (SELECT *, {pickup} AS p FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


# The characters Python's str.strip() removes.
_BLANKS = "".join(
    f" || chr({point})"
    for point in (9, 10, 11, 12, 13, 28, 29, 30, 31, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
)


def _split_items(source: str, column: str, delimiter: str, name: str) -> str:
    return f"""SELECT item AS {name} FROM (
      SELECT trim(piece, ' '{_BLANKS}) AS item
      FROM (SELECT unnest(string_split({column}, {delimiter})) AS piece FROM {source})) WHERE item <> ''"""


_ITEMS = _split_items("part", "p_name", "' '", "item")

_SKEWED = """SELECT CASE WHEN l_linenumber > 2 THEN -1 ELSE o_custkey END AS customer, l_orderkey,
        l_linenumber, n.rank AS rank
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN (SELECT c_custkey AS k, c_custkey * 2 AS rank FROM customer UNION ALL SELECT -1, 0) n
          ON n.k = CASE WHEN l_linenumber > 2 THEN -1 ELSE o_custkey END"""

ORACLE: dict[str, str] = {
    "scan_parquet": "SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem",
    "sink_parquet_roundtrip": "SELECT * FROM orders",
    "sink_table_roundtrip": """SELECT o_orderkey, c_custkey, c_name, o_orderdate
      FROM orders JOIN customer ON o_custkey = c_custkey""",
    "ctas_replace": f"WITH {_SALES} SELECT region, country, {_decode('order_priority')} AS priority FROM sales",
    "scan_table": f"""WITH {_SALES}
      SELECT region AS "REGION", item_type AS "ITEM TYPE", order_id AS "ORDER ID" FROM sales""",
    "raw_landing": f"WITH {_SALES} SELECT * FROM sales",
    "scan_parquet_widened": """SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey,
      CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate END AS o_orderdate FROM orders""",
    "raw_landing_fitting": """SELECT o_orderkey AS order_id, o_custkey AS customer, CAST(o_orderdate AS DATE) AS day
      FROM orders WHERE o_orderkey % 7 > 0""",
    "raw_landing_rejected": """SELECT o_orderkey || ',none,' || strftime(o_orderdate, '%Y-%m-%d') AS record,
      'cannot read Customer' AS reason FROM orders WHERE o_orderkey % 7 = 0""",
    "publish_together": """SELECT o_orderkey, c_custkey, c_name, o_orderdate
      FROM orders JOIN customer ON o_custkey = c_custkey""",
    "project_columns": f"""WITH {_TRIPS}
      SELECT "VendorID", tpep_pickup_datetime, trip_distance, total_amount FROM trips""",
    "derive_columns": f"""WITH {_TRIPS} SELECT "__null_dask_index__",
      CAST(month(tpep_pickup_datetime) AS INTEGER) AS "Month", {_DISTANCE} AS "Distance_Length",
      total_amount + extra AS total_amount FROM trips""",
    "split_trip": f"""WITH {_NUMBERED} SELECT "Trip_id", "VendorID", trip_distance, "Payment_id" FROM numbered""",
    "split_payment": f"""WITH {_NUMBERED} SELECT "Payment_id", payment_type, fare_amount, total_amount FROM numbered""",
    "rename_columns": f"""WITH {_SALES} SELECT order_id AS order_ref, item_type AS "Item_type" FROM sales""",
    "select_star_plus": """SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'Final' ELSE o_orderstatus END AS status_full
      FROM orders""",
    "filter_not_null": f"WITH {_GAPS} SELECT order_id, region, item_type FROM gaps WHERE region IS NOT NULL",
    "filter_all_keys_present": f"""WITH {_GAPS} SELECT order_id, item_type, region, country, order_priority
      FROM gaps WHERE {_KEYS_PRESENT}""",
    "predicate_combos": """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
      WHERE l_linenumber = 1 OR l_linenumber = 2 OR (l_quantity >= 5 AND l_quantity < 10)
        OR (l_quantity <= 2 AND l_extendedprice > 1000)""",
    "derived_table": """SELECT upper(c_mktsegment) AS segment, CAST(length(c_mktsegment) AS INTEGER) AS width
      FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL)""",
    "drop_column": f"""WITH {_TRIPS} SELECT * EXCLUDE ("__null_dask_index__") FROM trips""",
    "month_of_ts": "SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders",
    "bucket_equality": f"""WITH {_TRIPS}
      SELECT "__null_dask_index__" AS event_id, {_LOAD_EXACT} AS load FROM trips""",
    "bucket_threshold": f"""WITH {_TRIPS}
      SELECT "__null_dask_index__" AS event_id, {_LOAD_THRESHOLD} AS load FROM trips""",
    "bucket_half_open": f"""WITH {_TRIPS} SELECT "__null_dask_index__" AS event_id, {_DISTANCE} AS distance FROM trips""",
    "decode_labels": f"WITH {_GAPS} SELECT order_id, {_decode('order_priority')} AS priority FROM gaps",
    "convert_currency": f"""WITH {_TRIPS} SELECT "__null_dask_index__" AS event_id,
      total_amount * 83.0::DOUBLE AS at_default, total_amount * 85.25::DOUBLE AS at_rate FROM trips""",
    "cast_int": f"""SELECT l_orderkey, {_int('l_extendedprice / 8')} AS price_int,
      {_int('-l_extendedprice / 8')} AS negative_int, {_int('l_extendedprice * 1000000')} AS overflow_int
      FROM lineitem""",
    "cast_bigint": f"""SELECT CAST(l_linenumber AS BIGINT) AS line_bigint,
      {_int('l_extendedprice * 1000000', 'BIGINT')} AS price_bigint FROM lineitem""",
    "cast_timestamp": "SELECT event_id, CAST(ts AS TIMESTAMP) AS at FROM events",
    "timestamp_to_string": "SELECT event_id, CAST(ts AS VARCHAR) AS at FROM events",
    "try_parse_date": f"WITH {_GAPS} SELECT order_id, ship_date, {_strict('ship_date')} AS shipped FROM gaps",
    "parse_date_multi": f"WITH {_GAPS} SELECT order_id, ship_date, {_lenient('ship_date')} AS shipped FROM gaps",
    "lead_time_days": f"WITH {_SALES} SELECT order_id, order_date, ship_date, {_days(_strict)} AS days FROM sales",
    "explode_delimited": _ITEMS,
    "explode_text_lines": _split_items("documents", "text", "chr(10)", "line"),
    "distinct_column": "SELECT DISTINCT p_type FROM part",
    "distinct_expression": f"WITH {_SALES} SELECT DISTINCT {_decode('order_priority')} AS priority FROM sales",
    "count_distinct_items": f"SELECT count(DISTINCT item) AS items FROM ({_ITEMS})",
    "dim_surrogate_key": _dim("part", "p_name", "Name_id", "p_name"),
    "sequence_global": _sequences("o_orderdate", second=False),
    "sequence_second_order": _sequences("o_orderdate", second=True),
    "sequence_twin": f"""WITH {_NUMBERED}
      SELECT trip_id_a AS "Trip_id", trip_id_a AS "Payment_id", "__null_dask_index__" FROM numbered""",
    "sequence_hot_key": _sequences("CASE WHEN l_linenumber > 3 THEN o_orderdate END", second=True),
    "sequence_ties": """SELECT row_number() OVER (ORDER BY o_orderdate NULLS FIRST, l_suppkey) AS "Trip_id",
      o_orderdate AS pickup, l_suppkey AS vendor FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "dim_surrogate_key_large": _dim("customer", "c_name", "Name_id", "c_name"),
    "join_lookup_large": _SKEWED,
    "join_lookup_split": _SKEWED,
    "star_fact_shuffled": _fact(_GAPS, "gaps"),
    "join_fact_dim": f"""WITH {_SALES}, c AS ({_dim('sales', 'country', 'Country_id', 'k')})
      SELECT country, order_id, "Country_id" FROM sales JOIN c ON c.k = sales.country""",
    "join_computed_key": f"""WITH {_SALES}, p AS ({_dim('sales', _decode('order_priority'), 'OrderPriority_id', 'k')})
      SELECT s.priority AS "ORDER_PRIORITY_FULL", order_id, order_priority, "OrderPriority_id"
      FROM (SELECT *, {_decode('order_priority')} AS priority FROM sales) s JOIN p ON p.k = s.priority""",
    "star_fact": _fact(_GAPS, "gaps"),
    "taxi_b_trip": f"""WITH {_NUMBERED} SELECT "Trip_id", "VendorID", tpep_pickup_datetime, tpep_dropoff_datetime,
      {_PLACES}, "Payment_id", "Month", load_threshold AS "Car_utilization", "Distance_Length", "trip_amt_INR"
      FROM numbered""",
    "taxi_b_payment": f"""WITH {_NUMBERED} SELECT "Payment_id", {_AMOUNTS} FROM numbered""",
    "taxi_a_trip": f"""WITH {_NUMBERED} SELECT trip_id_a AS "Trip_id", "VendorID",
      CAST(tpep_pickup_datetime AS VARCHAR) AS tpep_pickup_datetime,
      CAST(tpep_dropoff_datetime AS VARCHAR) AS tpep_dropoff_datetime, {_PLACES}, "Month", "Distance_Length",
      load_exact AS "Car_utilization", "__null_dask_index__" FROM numbered""",
    "taxi_a_payment": f"""WITH {_NUMBERED} SELECT trip_id_a AS "Payment_id", trip_id_a AS "Trip_id", {_AMOUNTS}, "trip_amt_INR",
      "__null_dask_index__" FROM numbered""",
    "taxi_staged": f"""WITH {_NUMBERED} SELECT trip_id_a AS "Trip_id", trip_id_a AS "Payment_id", "VendorID",
      load_exact AS "Car_utilization", "trip_amt_INR", "__null_dask_index__" FROM numbered""",
    "taxi_restarted": f"""WITH {_NUMBERED} SELECT trip_id_a AS "Trip_id", trip_id_a AS "Payment_id", "VendorID",
      load_exact AS "Car_utilization", "trip_amt_INR", "__null_dask_index__" FROM numbered""",
    "taxi_transform_and_load": f"""WITH {_NUMBERED} SELECT "Trip_id", "Payment_id", "VendorID", payment_type,
      load_threshold AS "Car_utilization", "trip_amt_INR" FROM numbered""",
    "dim_region": f"WITH {_SALES} {_dim('sales', 'region', 'Region_id', 'REGION')}",
    "dim_country": f"WITH {_SALES} {_dim('sales', 'country', 'Country_id', 'COUNTRY')}",
    "dim_item": f"WITH {_SALES} {_dim('sales', 'item_type', 'Item_id', 'Item_type')}",
    "dim_priority": f"WITH {_SALES} {_dim('sales', _decode('order_priority'), 'OrderPriority_id', 'ORDER_PRIORITY')}",
    "dim_item_gaps": f"WITH {_GAPS} {_dim('gaps', 'item_type', 'Item_id', 'Item_type')}",
    "sales_star": _fact(_SALES, "sales"),
    "sales_star_published": _fact(_SALES, "sales"),
    "sales_star_raw_priority": f"""WITH {_GAPS}, {_dims('gaps', decode=False, keep_null=True)}
      SELECT sales_channel AS "SALES_CHANNEL", order_date AS "ORDER_DATE", order_id AS "ORDER_ID",
        ship_date AS "SHIP_DATE", units_sold AS "UNITS_SOLD", unit_price AS "UNIT_PRICE", unit_cost AS "UNIT_COST",
        total_revenue AS "TOTAL_REVENUE", total_cost AS "TOTAL_COST", total_profit AS "TOTAL_PROFIT",
        "Region_id", "Country_id", "Item_id", "OrderPriority_id", {_days(_lenient)} AS "SHIPMENT_LEAD_TIME"
      FROM gaps s JOIN r ON r.k = s.region JOIN c ON c.k = s.country JOIN i ON i.k = s.item_type
        JOIN p ON p.k = s.order_priority""",
    "sales_flat": _flat(_SALES, "sales", "order_priority", "ORDER_PRIORITY_DESC"),
    "sales_flat_named": _flat(_GAPS, "gaps", "order_priority", "ORDER_PRIORITY"),
    "sales_flat_in_place": _flat(_GAPS, "gaps", _decode("order_priority"), None),
}
