from pyspark.sql import functions as F

from millrace import functions as fn
from millrace.operators import dimension, dimensions, surrogate_key


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def pairs(df):
    return sorted(tuple(row) for row in df.collect())


def test_ids_follow_binary_text_order(spark):
    df = texts(spark, ["a", "Z", "é", "B", "a", None])
    assert pairs(dimension(df, "id", "name", F.col("v"))) == [(1, "B"), (2, "Z"), (3, "a"), (4, "é")]


def test_decode_comes_before_distinct(spark):
    df = texts(spark, ["H", "High", "M", None])
    assert pairs(dimension(df, "id", "p", fn.decode_labels(F.col("v")))) == [(1, "High"), (2, "Medium")]


def test_missing_value_can_be_kept_last(spark):
    df = texts(spark, ["b", None, "a", None])
    assert pairs(dimension(df, "id", "name", F.col("v"), keep_null=True)) == [(1, "a"), (2, "b"), (3, None)]


def test_types_and_names(spark):
    assert dimension(texts(spark, ["x"]), "X_id", "X", F.col("v")).dtypes == [("X_id", "bigint"), ("X", "string")]


def test_several_columns_at_once(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), (None, None)], "p string, q string")
    dims = dimensions(df, {"p_id": ("P", F.col("p")), "q_id": ("Q", F.col("q"))})
    assert {name: pairs(dim) for name, dim in dims.items()} == {"p_id": [(1, "a"), (2, "b")], "q_id": [(1, "x")]}


def test_column_without_values(spark):
    dims = dimensions(texts(spark, [None]), {"id": ("V", F.col("v"))})
    assert pairs(dims["id"]) == []


def test_many_values_are_numbered_by_many_tasks(spark, plan_of):
    values = spark.range(5000).select(F.when(F.col("id") > 0, F.concat(F.lit("k"), "id")).alias("v"))
    assert "Window" in plan_of(surrogate_key(values, "v", "id"))
    large = surrogate_key(values, "v", "id", one_task_rows=500)
    assert "row_number" not in plan_of(large)
    assert sorted(large.collect(), key=lambda r: r.id) == sorted(
        surrogate_key(values, "v", "id").collect(), key=lambda r: r.id
    )


def test_distinct_aggregates_before_the_shuffle(spark, plan_of):
    plan = plan_of(texts(spark, ["a"]).distinct())
    assert plan.count("HashAggregate") == 2
