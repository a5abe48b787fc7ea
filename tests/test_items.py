import pytest

from millrace.operators import count_distinct_items, explode_delimited


def lists(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "items string")


@pytest.mark.parametrize(
    "text",
    ["a; b;b;; c ;", "", ";", " ; ", "one", "\ta\n;\xa0b\u2003; c\x1f", "a;A;a ", "x" * 50_000 + ";" + "y" * 50_000],
)
def test_as_in_plain_python(spark, text):
    want = [item.strip() for item in text.split(";") if item.strip()]
    assert [row.item for row in explode_delimited(lists(spark, text), "items").collect()] == want
    assert count_distinct_items(lists(spark, text), "items").first()[0] == len(set(want))


def test_missing_list_has_no_items(spark):
    assert explode_delimited(lists(spark, None), "items").collect() == []
    assert count_distinct_items(lists(spark, None), "items").first()[0] == 0


@pytest.mark.parametrize("delimiter", ["|", ".", "||", "\\", " ", "\n", "ab", "\\E", "]["])
def test_delimiter_is_literal(spark, delimiter):
    text = delimiter.join(["x", "y", "z"])
    assert [row.item for row in explode_delimited(lists(spark, text), "items", delimiter).collect()] == ["x", "y", "z"]


def test_distinct_over_all_lists(spark):
    assert count_distinct_items(lists(spark, "a;b", "b;c", "C"), "items", name="n").collect() == [(4,)]
