"""Column, filter, reshape, union and order operators on a few literal rows."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake import schemas
from spendlake.operators import columns as C
from spendlake.operators import combine, filters, ordering, reshape


def test_headers_are_trimmed_and_renamed_all_at_once(spark):
    df = spark.createDataFrame([("p", "full", 1)], [" practice_code", "full_practice_code ", "Avg."])
    renamed = C.rename_synonyms(
        C.trim_headers(df), {"practice_code": "practice_code_processed", "full_practice_code": "practice_code"}
    )
    assert renamed.columns == ["practice_code_processed", "practice_code", "Avg."]
    assert renamed.first()["practice_code"] == "full"


def test_rename_takes_the_header_by_exact_case(spark):
    df = spark.createDataFrame([("a", "b")], ["State", "stateful"])
    assert C.rename_synonyms(df, {"State": "state_name", "state": "other"}).columns == ["state_name", "stateful"]


def test_rename_to_equal_names_is_an_error(spark):
    df = spark.createDataFrame([("a", "b")], ["State Name", "region"])
    with pytest.raises(ValueError):
        C.rename_synonyms(df, {"State Name": "x", "region": "x"})


def test_trim_columns_skips_absent_ones(spark, rows):
    df = spark.createDataFrame([(" a ", " b ")], ["x", "y"])
    assert rows(C.trim_columns(df, ["x", "z"])) == [("a", " b ")]


def test_columns_with_dots_and_parentheses(spark, rows):
    df = spark.createDataFrame([(1, 2, 3)], ["Avg.", "Total ($1000)", "c"])
    assert rows(C.select_columns(df, ["Total ($1000)", "Avg."])) == [(2, 1)]


def test_select_year_columns(spark):
    df = spark.createDataFrame([("x", 1, 2, 3, 4)], ["State", "2013", "2014", "2015", "Avg."])
    assert C.select_year_columns(df, "State", 2014, 2020, ["Avg."]).columns == ["State", "2014", "2015"]
    with pytest.raises(ValueError):
        C.select_year_columns(df, "State", 2014, 2020)


def test_scale_keeps_source_decimals(spark):
    df = spark.createDataFrame([("0.12345",), (None,)], ["amount"])
    assert [r[0] for r in C.scale(df, "amount", 1000).collect()] == [Decimal("123.45"), None]


def test_recode_one_and_all_columns(spark, rows):
    df = spark.createDataFrame([("DMC", "DMC", 1), ("x", None, 2)], ["a", "b", "n"])
    assert rows(C.recode(df, "a", {"DMC": "Dairy"})) == [("Dairy", "DMC", 1), ("x", None, 2)]
    assert rows(C.recode_all(df, {"DMC": "Dairy"})) == [("Dairy", "Dairy", 1), ("x", None, 2)]


def test_maps_both_ways(spark, rows):
    df = spark.createDataFrame([("AK",), ("ZZ",), (None,)], "s string")
    names = {"AK": "Alaska", "AL": "Alabama"}
    forward = C.map_forward(df, "s", names)
    assert rows(forward) == [("Alaska",), (None,), (None,)]
    assert rows(C.map_reverse(forward, "s", names, "code"), "code") == [("AK",), (None,), (None,)]


def test_storage_rounds_half_up_and_nulls_what_does_not_fit(spark):
    df = spark.createDataFrame(
        [(438558.8333, "1.005", 1.0), (2.5, "1e13", float("nan"))], "recipient_count double, payment string, base_acres double"
    )
    stored = C.to_storage(df.withColumn("payment", F.col("payment").cast("double")), schemas.PAYMENTS).collect()
    assert stored[0]["recipient_count"] == 438559 and stored[1]["recipient_count"] == 3
    assert stored[0]["payment"] == Decimal("1.01") and stored[1]["payment"] is None
    assert stored[1]["base_acres"] is None


def test_strict_storage_fails_on_overflow(spark):
    df = spark.createDataFrame([(1e13,)], "payment double")
    with pytest.raises(Exception, match="(?i)overflow|out.of.range"):
        C.to_storage(df, schemas.PAYMENTS, strict=True).collect()


def test_project_to_schema_fills_and_orders(spark):
    df = spark.createDataFrame([(float("nan"), "AK", "extra")], ["payment", "state_code", "other"])
    out = C.project_to_schema(df, schemas.PAYMENTS)
    assert out.columns == schemas.PAYMENTS.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.PAYMENTS]
    assert out.first()["payment"] is None and out.first()["state_code"] == "AK"


def test_years_are_inclusive(spark, rows):
    df = spark.createDataFrame([(2013,), (2014,), (2018,), (2019,)], ["year"])
    assert rows(filters.years(df, 2014, 2018)) == [(2014,), (2018,)]


def test_require_drops_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "v double")
    assert filters.require(df, "v").count() == 1
    assert filters.require(df.select(F.col("v").cast("string")), "v").count() == 2


def test_membership_splits_every_row(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert rows(filters.keep_in(df, "v", ["a"])) == [("a",)]
    assert rows(filters.keep_not_in(df, "v", ["a"])) == [("b",), (None,)]


def test_exactly_once(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "k string, v int")
    assert rows(filters.exactly_once(df, ["k"])) == [("a", 1), (None, 4)]
    assert rows(filters.exactly_once(df.select("k"), ["k"])) == [("a",), (None,)]
    assert filters.exactly_once(df, ["v"]).columns == ["k", "v"]


def test_for_node_rejects_unknown_levels(spark):
    with pytest.raises(ValueError):
        filters.for_node(spark.range(1), "county", 1)


def test_passing_and_failing_cover_every_row(spark, rows):
    df = spark.createDataFrame([(1, "a"), (5, "a"), (1, None), (None, "b")], "n int, s string")
    rules = {"too large": F.col("n") < 5, "no text": F.col("s").isNotNull()}
    assert rows(filters.passing(df, rules)) == [(1, "a")]
    assert rows(filters.failing(df, rules), "reason") == [("no text",), ("too large",), ("too large",)]


WIDE = [
    ("Alabama", "1.005", "2"),
    ("Alaska", None, "3"),
    ("Texas", "7", "8"),
    ("Texas", "9", "10"),
    ("Guam", "1", "1"),
    (None, "2.8E+99", "6"),
]


def test_wide_to_long(spark, rows):
    df = spark.createDataFrame(WIDE, ["state_name", "2014", "2015"])
    long = reshape.wide_to_long(df, 2014, 2015, "Price Loss Coverage (PLC)", "Total Payment")
    assert rows(long.select("state_code", "year", "entity_type", F.col("amount").cast("string"))) == [
        ("AK", 2014, "program", None),
        ("AK", 2015, "program", "3.00"),
        ("AL", 2014, "program", "1.01"),
        ("AL", 2015, "program", "2.00"),
    ]


def test_wide_to_long_other_measures(spark):
    df = spark.createDataFrame(WIDE[:2], ["state_name", "2014", "2015"])
    acres = reshape.wide_to_long(df, 2014, 2014, "Total CRP", "Base Acres")
    assert acres.columns[-1] == "base_acres" and acres.first()["entity_type"] == "unknown"
    assert reshape.wide_to_long(df, 2014, 2014, "Total CRP", "Payee Count").columns[-1] == "recipient_count"


def test_wide_rejects(spark, rows):
    df = spark.createDataFrame(WIDE, ["state_name", "2014", "2015"])
    assert rows(reshape.wide_rejects(df)) == [
        ("Guam", 1, "unknown state"),
        ("Texas", 2, "state occurs more than once"),
        (None, 1, "unknown state"),
    ]


def test_stack_groups_scans_once(spark, rows, plan, tmp_path):
    data = [(2014, "OHIO", 1, 2, 3, None)]
    names = ["year", "state", "A - PAY ($1000)", "A - FARMS", "B - PAY ($1000)", "B - FARMS"]
    path = str(tmp_path / "groups")
    spark.createDataFrame(data, "a int, b string, c int, d int, e int, f int").toDF(*names).write.parquet(path)
    groups = [("A", "first", "sub_program"), ("B", "second", "sub_sub_program")]
    stacked = reshape.stack_groups(
        spark.read.parquet(path), ["year", "state"], groups, {"PAY ($1000)": "amount", "FARMS": "farm_count"}
    )
    assert rows(stacked) == [
        (2014, "OHIO", "first", "sub_program", 1, 2),
        (2014, "OHIO", "second", "sub_sub_program", 3, None),
    ]
    assert plan(stacked).count("FileScan") == 1 and "Exchange" not in plan(stacked)


def test_unions(spark, rows):
    a = spark.createDataFrame([(1, "x")], ["n", "s"])
    b = spark.createDataFrame([("y", 2)], ["s", "n"])
    c = spark.createDataFrame([(3,)], ["n"])
    assert rows(combine.union_all(a, b)) == [(1, "x"), (2, "y")]
    assert rows(combine.union_missing(a, b, c)) == [(1, "x"), (2, "y"), (3, None)]


def test_first_by_key_and_priority_merge(spark, rows):
    first = spark.createDataFrame([("1", "late", 9), ("1", "early", 1), ("2", "b", 5)], ["code", "name", "ord"])
    second = spark.createDataFrame([("2", "no", 0), ("3", "c", 7), ("3", "d", 8)], ["code", "name", "ord"])
    assert rows(combine.first_by_key(first, ["code"], ["ord"])) == [("1", "early", 1), ("2", "b", 5)]
    merged = combine.priority_merge([(first, "A"), (second, "B")], ["code"], ["ord"])
    assert rows(merged) == [("1", "early", 1, "A"), ("2", "b", 5, "A"), ("3", "c", 7, "B")]


def test_rank_report_puts_nulls_first(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert [r[0] for r in ordering.rank_report(df, "v").collect()] == [None, 3, 1]


def test_codes_sort_as_text(spark):
    df = spark.createDataFrame([("9",), ("10",), ("B",)], "practice_code string")
    assert [r[0] for r in ordering.order_by_code(df).collect()] == ["10", "9", "B"]


def test_with_position_is_dense_over_many_partitions(spark):
    df = spark.range(5000).repartition(7).withColumn("k", F.col("id") % 3)
    placed = ordering.with_position(df, "k", F.desc("id"), start=10)
    got = [(r["k"], -r["id"]) for r in placed.orderBy("position").collect()]
    assert got == sorted(got)
    stats = placed.agg(F.min("position"), F.max("position"), F.countDistinct("position")).first()
    assert tuple(stats) == (10, 5009, 5000)
    assert placed.schema["position"].dataType == T.LongType()


def test_with_position_of_nothing(spark):
    assert ordering.with_position(spark.range(0), "id").count() == 0


def test_ranked_rows_of_equal_value_have_an_order(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None), ("d", 2.0), ("a", None)], "state string, total double")
    for parts in (1, 4):
        found = [tuple(row) for row in ordering.rank_report(df.repartition(parts), "total").collect()]
        assert found == [("a", None), ("c", None), ("d", 2.0), ("a", 1.0), ("b", 1.0)]
