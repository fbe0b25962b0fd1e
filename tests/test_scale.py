"""Plan shapes that must hold at any size, and hot keys that must stay whole."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import REGISTERED
from spendlake.operators import combine, filters, joins
from spendlake.operators.ordering import with_position
from spendlake.plans import reports
from spendlake.session import scratch_path, shared_dir
from spendlake.sources.tables import append_facts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def hot(spark):
    """A key that holds a third of 60 000 rows, the others in small groups."""
    rows = spark.range(60_000)
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 4999).cast("string")))
    return rows.select("id", key.alias("key"), (F.col("id") % 2 + 2014).cast("int").alias("year"))


def test_first_by_key_limits_before_the_shuffle(hot, plan):
    first = combine.first_by_key(hot, ["key"], ["id"])
    before_shuffle = plan(first).split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert first.where("key = 'hot'").first()["id"] == 0
    assert first.count() == hot.select("key").distinct().count()


def test_exactly_once_moves_keys_only(spark, hot, plan, tmp_path, monkeypatch):
    hot.withColumn("key", F.when(F.col("id") < 10, F.col("id").cast("string")).otherwise(F.col("key"))).write.parquet(
        str(tmp_path / "hot")
    )
    rows = spark.read.parquet(str(tmp_path / "hot"))
    once = filters.exactly_once(rows, ["key"])
    text = plan(once)
    assert "SortAggregate" not in text and "Sort " not in text and "hashpartitioning" not in text
    assert sorted(row["id"] for row in once.collect()) == list(range(10))
    # The keys that repeat are too many to be sent to every task.
    monkeypatch.setattr(filters, "small_side", lambda df: df)
    assert sorted(row["id"] for row in filters.exactly_once(rows, ["key"]).collect()) == list(range(10))
    assert sorted(row["id"] for row in filters.exactly_once(rows, ["key"], bounded=True).collect()) == list(range(10))


def test_match_contains_has_no_pairwise_join(hot, spark, plan):
    reference = spark.createDataFrame([("hot", 2), ("k1", 1), ("ot", 3)], "ref string, place int")
    matched = joins.match_contains(hot, reference, "key", "ref", "place")
    assert "NestedLoop" not in plan(matched) and "Cartesian" not in plan(matched)
    counts = {row["matched_code"]: row["count"] for row in matched.groupBy("matched_code").count().collect()}
    assert counts["hot"] == 20_000 and sum(counts.values()) == 60_000


def test_positions_of_equal_keys_are_all_kept(hot):
    placed = with_position(hot, "key", "id")
    span = placed.where("key = 'hot'").agg(F.min("position"), F.max("position"), F.count("*")).first()
    assert span[1] - span[0] + 1 == span[2] == 20_000


def test_a_hot_sort_key_is_spread(spark):
    same = spark.range(80_000).select(F.lit("hot").alias("key"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = with_position(same, "key")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert placed.agg(F.countDistinct("position")).first()[0] == 80_000
    assert placed.select(F.spark_partition_id()).distinct().count() > 4


def test_reports_prune_partitions_and_columns(spark, hot, plan, tmp_path):
    facts = hot.withColumns(
        {
            "title_id": F.lit(100),
            "state_code": F.col("key"),
            "payment": F.lit(1).cast("decimal(14,2)"),
            "unused": F.lit("x"),
        }
    )
    append_facts(facts, str(tmp_path / "facts"))
    table = spark.read.parquet(str(tmp_path / "facts"))
    text = plan(reports.state_totals(table, "title", 100, 2015, 2018))
    assert re.search(r"PartitionFilters: \[.*year.* >= 2015", text)
    assert "PushedFilters: [IsNotNull(title_id), EqualTo(title_id,100)]" in text
    assert "unused" not in text
    assert "partial_sum" in text.split("Exchange hashpartitioning")[-1]


def test_open_share_reads_the_facts_once(spark, hot, plan, tmp_path):
    hot.select(
        F.lit(100).alias("title_id"), F.col("key").alias("state_code"), "year", F.lit(1).cast("decimal(14,2)").alias("payment")
    ).write.parquet(str(tmp_path / "facts"))
    titles = spark.createDataFrame([(100, "T")], "id int, name string")
    for bounded in (True, False):
        share = reports.state_share(spark.read.parquet(str(tmp_path / "facts")), titles, "title", 100, 2014, 2014, bounded)
        assert plan(share).count("FileScan") == 1


def test_a_hot_partition_value_is_written_whole(spark, hot, tmp_path):
    path = append_facts(hot.withColumn("year", F.lit(2014)), str(tmp_path / "one-year"))
    assert spark.read.parquet(path).count() == 60_000


def test_no_query_uses_python_workers(spark, plan):
    for name in ("load_facts", "practice_lists", "arc_plc_payments", "parse_nested"):
        text = plan(REGISTERED[name].run(spark, SF))
        assert "Python" not in text and "Pandas" not in text


def test_scratch_paths_follow_the_session(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_dir(spark) == named and scratch_path(spark, "x").startswith(named)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
