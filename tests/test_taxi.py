import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.plans import taxi
from millrace.registry.inputs import trips as registered_trips
from millrace.sources import read_parquet, write_parquet

NOON = datetime.datetime(2024, 3, 1, 12)

HALF = ("extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "congestion_surcharge")


@pytest.fixture
def trips(spark):
    """Pairs of trips share pick-up time and vendor."""

    def build(n=60):
        i = F.col("id")
        return spark.range(n).select(
            (i % 3).cast("double").alias("VendorID"),
            F.when(i != 5, F.lit(NOON) - F.make_interval(hours=i % 10)).cast("timestamp_ntz").alias(taxi.PICKUP),
            F.lit(NOON).cast("timestamp_ntz").alias(taxi.DROPOFF),
            F.when(i % 9 != 0, i % 7 / 2).alias("passenger_count"),
            (i / 4).alias("trip_distance"),
            F.lit(1.0).alias("RatecodeID"),
            F.lit("N").alias("store_and_fwd_flag"),
            i.cast("int").alias("PULocationID"),
            i.cast("int").alias("DOLocationID"),
            (i % 4).cast("double").alias("payment_type"),
            i.cast("double").alias("fare_amount"),
            F.when(i != 7, i * 1.5).alias("total_amount"),
            *[F.lit(0.5).alias(name) for name in HALF],
            i.alias("__null_dask_index__"),
        )

    return build


TIE = ["__null_dask_index__"]


def test_columns_and_types(trips):
    for variant, counts in ((taxi.VARIANT_A, (14, 13)), (taxi.VARIANT_B, (15, 10))):
        tables = taxi.transform(trips(), variant)
        assert tuple(len(df.columns) for df in tables) == counts
        kinds = dict(tables.trip.dtypes)
        assert kinds["Trip_id"] == "bigint"
        assert kinds["VendorID"] == kinds["passenger_count"] == kinds["Month"] == "int"
        assert kinds["PULocationID"] == "bigint"
    assert dict(taxi.transform(trips()).trip.dtypes)[taxi.PICKUP] == "timestamp"
    assert dict(taxi.transform(trips(), taxi.VARIANT_A).trip.dtypes)[taxi.PICKUP] == "string"


def test_buckets_see_the_uncast_count(trips):
    row = taxi.enrich(trips(), taxi.VARIANT_B).where(F.col("__null_dask_index__") == 5).first()
    assert (row.passenger_count, row.Car_utilization) == (2, "Medium")
    row = taxi.enrich(trips(), taxi.VARIANT_A).where(F.col("__null_dask_index__") == 5).first()
    assert (row.passenger_count, row.Car_utilization) == (2, "Unknown")


def test_rate(trips):
    amounts = {r["__null_dask_index__"]: r.trip_amt_INR for r in taxi.enrich(trips(), rate=2.0).collect()}
    assert (amounts[2], amounts[7]) == (6.0, None)


@pytest.mark.parametrize("variant", [taxi.VARIANT_A, taxi.VARIANT_B], ids="ab")
def test_split_tables_join_back_to_all_rows(trips, variant):
    trip, payment = taxi.transform(trips(), variant)
    key = "Trip_id" if variant is taxi.VARIANT_A else "Payment_id"
    assert sorted(r.Trip_id for r in trip.collect()) == list(range(1, 61))
    assert sorted(r.Payment_id for r in payment.collect()) == list(range(1, 61))
    joined = trip.select(key, "PULocationID").join(payment.select(key, "fare_amount"), key).collect()
    assert len(joined) == 60
    assert all(r.PULocationID == r.fare_amount for r in joined)


def test_runs_agree_under_a_total_order(trips):
    for one, two in zip(taxi.transform(trips(), tie_break=TIE), taxi.transform(trips(), tie_break=TIE)):
        assert sorted(one.collect(), key=str) == sorted(two.collect(), key=str)


def test_ties_go_by_all_columns_that_do_not_follow_from_others(trips):
    order = taxi.VARIANT_B.output_columns
    assert set(taxi.FOLLOWING) < set(order)
    numbered = taxi.number(taxi.enrich(trips()))
    assert [c for c in numbered.columns if c not in order] == []
    rows = sorted(numbered.where("PULocationID >= 50").collect(), key=lambda r: r.Trip_id)
    keys = [(r[taxi.PICKUP], r.VendorID, r.passenger_count or 0, r.trip_distance) for r in rows]
    assert keys == sorted(keys)


def test_swapped_payment_columns_turn_the_check_red(spark):
    """The registered trips tell every pair of output columns apart."""
    sf_dir = "/root/testdata/sf0.001"
    if not Path(sf_dir).exists():
        pytest.skip("needs the test tables")
    rows = registered_trips(spark, sf_dir).cache()
    names = [*taxi.PAYMENT_AMOUNTS, "congestion_surcharge", taxi.PICKUP, taxi.DROPOFF]
    digests = rows.agg(*[F.md5(F.concat_ws(",", F.sort_array(F.collect_list(F.col(n).cast("string"))))).alias(n) for n in names])
    assert len(set(digests.first())) == len(names)
    for name in names[1:]:
        assert rows.where(F.col(name) % 1 != 0).count() > 0 if "date" not in name else True
    assert rows.groupBy(taxi.PICKUP, "VendorID").count().where("count > 1").count() > 0


def test_missing_pickup_comes_first(trips):
    first = taxi.transform(trips(), tie_break=TIE).trip.where("Trip_id = 1").first()
    assert (first[taxi.PICKUP], first.Month, first.PULocationID) == (None, None, 5)


def test_empty_input(trips):
    for df in (*taxi.transform(trips(0)), *taxi.transform(trips(0), taxi.VARIANT_A)):
        assert df.collect() == []


def test_stages_pass_files(spark, trips, tmp_path):
    source, extracted, trip, payment = (str(tmp_path / name) for name in ("source", "extracted", "trip", "payment"))
    write_parquet(trips(), source)
    saved = {}
    for _ in range(2):
        taxi.extract(spark, source, extracted)
        taxi.transform_files(spark, extracted, trip, payment, tie_break=TIE)
        taxi.load(spark, trip, payment, lambda df, name: saved.update({name: df}))
    want = taxi.transform(trips(), taxi.VARIANT_A, tie_break=TIE)
    assert list(saved) == list(taxi.TABLES)
    for got, expected in zip(saved.values(), want, strict=True):
        assert sorted(got.collect(), key=str) == sorted(expected.collect(), key=str)


def test_scheduled_job(spark, trips, tmp_path):
    source = str(tmp_path / "source")
    write_parquet(trips(), source)
    taxi.transform_and_load(
        spark, source, lambda df, name: write_parquet(df, str(tmp_path / name)), rate=2.0, tie_break=TIE
    )
    trip, payment = (read_parquet(spark, str(tmp_path / name)) for name in taxi.TABLES)
    joined = trip.join(payment, "Payment_id").where("trip_amt_INR <> total_amount * 2 OR total_amount IS NULL")
    assert joined.count() == 1


def test_a_failed_load_goes_on_without_extracting_again(spark, trips, tmp_path, monkeypatch):
    source, work = str(tmp_path / "source"), str(tmp_path / "work")
    trips().write.parquet(source)
    extracted, loaded = [], {}
    extract = taxi.extract
    monkeypatch.setattr(taxi, "extract", lambda *a: extracted.append(a) or extract(*a))

    def save(df, name, broken=True):
        if broken and name == taxi.TABLES[1]:
            raise RuntimeError("no connection")
        loaded[name] = sorted(row[0] for row in df.collect())  # the ids

    with pytest.raises(RuntimeError, match="no connection"):
        taxi.staged_run(spark, source, work, "may", save)
    assert list(loaded) == [taxi.TABLES[0]]
    first = dict(loaded)
    loaded.clear()
    assert taxi.staged_run(spark, source, work, "may", lambda df, name: save(df, name, False)) == [f"load_{taxi.TABLES[1]}"]
    assert list(loaded) == [taxi.TABLES[1]] and len(extracted) == 1
    assert first[taxi.TABLES[0]] == loaded[taxi.TABLES[1]] == list(range(1, 61))
    assert taxi.staged_run(spark, source, work, "may", save) == []
    loaded.clear()
    assert len(taxi.staged_run(spark, source, work, "june", lambda df, name: save(df, name, False))) == 4
    assert len(extracted) == 2 and len(loaded) == 2
