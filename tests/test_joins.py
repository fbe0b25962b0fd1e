"""Look-ups, rejects, quality checks and table changes."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from spendlake.operators import joins, quality
from spendlake.operators.joins import Dimensions
from spendlake.sources import parts, tables


@pytest.fixture(scope="module")
def dims(spark):
    make = spark.createDataFrame
    return Dimensions(
        states=make([("AK", "Alaska")], "code string, name string"),
        titles=make([(100, "T1"), (101, "T2")], "id int, name string"),
        subtitles=make([(100, 100, "S1"), (101, 101, "S1")], "id int, title_id int, name string"),
        programs=make(
            [(100, 100, 100, "P1"), (101, 101, None, "P2"), (102, 101, None, "P1")],
            "id int, title_id int, subtitle_id int, name string",
        ),
        sub_programs=make([(100, 101, "A"), (101, 100, "B"), (99, 999, "A")], "id int, program_id int, name string"),
        sub_sub_programs=make([(100, 101, "X")], "id int, sub_program_id int, name string"),
        practice_categories=make([(100, "C", 100), (101, "C", 101)], "id int, name string, program_id int"),
        practices=make([("340",)], "code string"),
    )


def test_entity_dimension_takes_the_smallest_id(spark, dims, rows):
    assert rows(joins.entity_dimension(dims)) == [
        ("program", "P1", 100, 100, 100, None, None),
        ("program", "P2", 101, None, 101, None, None),
        ("sub_program", "A", 101, None, 101, 100, None),
        ("sub_program", "B", 100, 100, 100, 101, None),
        ("sub_sub_program", "X", 100, 100, 100, 101, 100),
        ("subtitle", "S1", 100, 100, None, None, None),
    ]


def test_resolve_each_level(spark, dims, rows):
    def resolve(function, name):
        facts = spark.createDataFrame([(1, name), (2, "nobody"), (3, None)], "i int, entity_name string")
        return rows(function(facts, dims))

    assert resolve(joins.resolve_subtitle, "S1") == [("S1", 1, 100, 100)]
    assert resolve(joins.resolve_program, "P1") == [("P1", 1, 100, 100, 100)]
    assert resolve(joins.resolve_sub_program, "A") == [("A", 1, 101, None, 101, 100)]
    assert resolve(joins.resolve_sub_sub_program, "X") == [("X", 1, 100, 100, 100, 101, 100)]


def test_resolve_entities_needs_type_and_name(spark, dims, rows):
    facts = spark.createDataFrame(
        [(1, "program", "P2"), (2, "subtitle", "P2"), (3, "unknown", "P2")], "i int, entity_type string, entity_name string"
    )
    assert rows(joins.resolve_entities(facts, dims), "i", "program_id") == [(1, 101)]


def test_resolve_category_keeps_every_row(spark, dims, rows):
    facts = spark.createDataFrame([(1, "C", 101), (2, None, 101), (3, "D", 100)], "i int, practice_category string, program_id int")
    got = rows(joins.resolve_category(facts, dims.practice_categories), "i", "practice_category_id")
    assert got == [(1, 101), (2, None), (3, None)]


def test_rejects_keep_null_keys(spark, dims, rows):
    df = spark.createDataFrame([("AK",), ("ZZ",), (None,)], "code string")
    assert rows(joins.rejects(df, dims.states, ["code"], "unknown")) == [("ZZ", "unknown"), (None, "unknown")]


def test_large_sides_are_not_broadcast(spark, plan):
    big = spark.range(1000)
    assert "ResolvedHint" in joins.small_side(big, limit=1000)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in joins.small_side(big, limit=999)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in joins.small_side(big, spark.range(5), limit=10)._jdf.queryExecution().analyzed().toString()
    bounds = (spark.range(5), spark.range(6))
    assert "ResolvedHint" not in joins.small_side(big, *bounds, limit=10)._jdf.queryExecution().analyzed().toString()


def test_match_contains_against_brute_force(spark):
    source = random.Random(3)
    listed = ["".join(source.choices("123", k=source.randint(1, 3))) for _ in range(25)]
    codes = ["".join(source.choices("12345", k=source.randint(0, 7))) for _ in range(300)] + ["", "2", "555"]
    expected = [next((ref for ref in listed if ref in code), None) for code in codes]
    reference = spark.createDataFrame([(ref, i) for i, ref in enumerate(listed)], "ref string, place int")
    df = spark.createDataFrame(list(enumerate(codes)), "i int, code string")
    got = joins.match_contains(df, reference, "code", "ref", "place").orderBy("i").collect()
    assert [row["matched_code"] for row in got] == expected


def test_match_contains_edges(spark, rows):
    df = spark.createDataFrame([("abc",), (None,), ("abc",)], "code string")
    empty = spark.createDataFrame([], "ref string, place int")
    assert rows(joins.match_contains(df, empty, "code", "ref", "place")) == [("abc", None), ("abc", None), (None, None)]
    blank = spark.createDataFrame([("bc", 2), ("", 1)], "ref string, place int")
    assert rows(joins.match_contains(df, blank, "code", "ref", "place")) == [("abc", ""), ("abc", ""), (None, None)]


def test_checks(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (1, "a", 99999.994), (2, None, 99999.995), (None, "long text", None)], "k int, s string, n double"
    )
    assert rows(quality.check_pk(df, ["k"])) == [(1, 2, "duplicate key"), (None, 1, "null key")]
    assert rows(quality.check_unique(df, ["k", "s"])) == [(1, "a", 2)]
    assert rows(quality.check_not_null(df, ["k", "s"]), "k") == [(2,), (None,)]
    assert rows(quality.check_length(df, "s", 8), "s") == [("long text",)]
    assert rows(quality.check_precision(df, "n", 7, 2), "n") == [(99999.995,)]
    parents = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    assert rows(quality.check_fk(df, "k", parents, "id"), "k") == [(2,)]


def test_precision_far_out_of_range_is_a_misfit(spark):
    df = spark.createDataFrame([(1e35,), (-1e13,), (1.0,)], "n double")
    assert quality.check_precision(df, "n", 14, 2).count() == 2


def test_assign_ids(spark, rows):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("c", 3)], "name string, ord int")
    assert rows(quality.assign_ids(df, "ord")) == [(100, "a", 1), (101, "b", 2), (102, "c", 3)]


def test_upsert_last_writer_wins(spark, rows):
    base = spark.createDataFrame([("1", "old"), ("2", "kept")], "code string, name string")
    updates = spark.createDataFrame([("1", "first", 1), ("1", "last", 2), ("3", "new", 1)], "code string, name string, ord int")
    assert rows(tables.upsert(base, updates, ["code"], ["ord"])) == [("1", "last"), ("2", "kept"), ("3", "new")]


def test_insert_if_absent(spark, rows):
    base = spark.createDataFrame([("1", "old")], "code string, name string")
    new = spark.createDataFrame([("1", "no", 1), ("2", "yes", 1), ("2", "again", 2)], "code string, name string, ord int")
    assert rows(tables.insert_if_absent(base, new, ["code"], ["ord"])) == [("1", "old"), ("2", "yes")]


def test_append_and_replace(spark, rows, tmp_path):
    facts = spark.createDataFrame([(2014, 1), (2015, 2), (2015, 3)], "year int, v int")
    path = str(tmp_path / "appended")
    tables.append_facts(facts, path)
    tables.append_facts(facts.where("year = 2014"), path)
    assert rows(spark.read.parquet(path).groupBy("year").count()) == [(2014, 2), (2015, 2)]
    path = str(tmp_path / "replaced")
    tables.replace_source(facts, path, "a")
    tables.replace_source(facts.where("year = 2015"), path, "b")
    tables.replace_source(facts.where("year = 2015"), path, "a")
    table = tables.open_sources(spark, path, facts.schema)
    assert rows(table.groupBy("source", "year").count()) == [("a", 2015, 2), ("b", 2015, 2)]
    assert parts.drop_replaced(spark, path, "source", parts.current(spark, path)) == 1
    assert table.count() == 4
    pruned = table.where("year = 2014 AND source = 'a'")
    assert pruned.count() == 0


def test_combine_measures(spark, rows):
    keys = "state_code string, year int, entity_name string, entity_type string"
    base = spark.createDataFrame([("AK", 2014, "e", "t", 1), ("AK", 2015, "e", "t", 2)], f"{keys}, amount int")
    acres = spark.createDataFrame([("AK", 2014, "e", "t", 7)], f"{keys}, base_acres int")
    people = spark.createDataFrame([("AK", 2015, "e", "t", 9), ("AL", 2015, "e", "t", 9)], f"{keys}, recipient_count int")
    combined = joins.combine_measures(base, acres, people)
    assert rows(combined, "year", "amount", "base_acres", "recipient_count") == [(2014, 1, 7, None), (2015, 2, None, 9)]


def test_with_name_drops_unmatched(spark, dims, rows):
    facts = spark.createDataFrame([(100, 1), (555, 2)], "title_id int, v int")
    assert rows(joins.with_name(facts, dims.titles, "title_id", "title_name"), "title_name", "v") == [("T1", 1)]


def test_leaf_rows(spark, rows):
    from spendlake.plans.reports import leaf_rows

    subs = spark.createDataFrame([(102, "Total CRP"), (104, "Continuous Sign-up"), (103, "General Sign-up")], "id int, name string")
    facts = spark.createDataFrame(
        [(1, 102, None), (2, 104, None), (3, 104, 100), (4, 103, None), (5, None, None)],
        "i int, sub_program_id int, sub_sub_program_id int",
    )
    assert rows(leaf_rows(facts, subs), "i") == [(3,), (4,), (5,)]
    assert rows(leaf_rows(facts.withColumn("x", F.lit(1)), subs.limit(0)), "i") == [(1,), (2,), (3,), (4,), (5,)]


def test_a_replace_that_dies_changes_nothing(spark, rows, tmp_path):
    facts = spark.createDataFrame([(2014, 1), (2015, 2)], "year int, v int")
    path = str(tmp_path / "facts")
    tables.replace_source(facts, path, "a")
    broken = facts.withColumn("v", F.when(F.col("year") == 2015, F.raise_error(F.lit("dead"))).otherwise(7).cast("int"))
    with pytest.raises(Exception, match="dead"):
        tables.replace_source(broken, path, "a")
    assert rows(tables.open_sources(spark, path, facts.schema), "year", "v", "source") == [(2014, 1, "a"), (2015, 2, "a")]
    # Also where the files were written and only the switch was not.
    tables.stage_source(facts.limit(1), path, "a", parts.new_load())
    assert tables.open_sources(spark, path, facts.schema).count() == 2
    assert tables.open_sources(spark, str(tmp_path / "none"), facts.schema).count() == 0


def test_upsert_into_keeps_the_files_of_other_buckets(spark, rows, tmp_path):
    base = spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    path = tables.lay_out(base, str(tmp_path / "t"), ["k"], 16)
    files = lambda: {row[0] for row in tables.open_buckets(spark, path, base.schema).select("_metadata.file_path").distinct().collect()}
    before = files()
    updates = spark.createDataFrame([(5, "first", 1), (5, "last", 2), (5000, "new", 1)], "k long, v string, ord int")
    assert tables.upsert_into(spark, path, base.schema, updates, ["k"], ["ord"]) <= 2
    assert len(before & files()) >= 14
    table = tables.open_buckets(spark, path, base.schema)
    assert rows(table.where("v <> 'old'")) == [(5, "last"), (5000, "new")] and table.count() == 1001
    assert tables.upsert_into(spark, path, base.schema, updates.limit(0), ["k"], ["ord"]) == 0
    broken = updates.withColumn("v", F.when(F.col("k") == 5, F.raise_error(F.lit("dead"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="dead"):
        tables.upsert_into(spark, path, base.schema, broken, ["k"], ["ord"])
    assert rows(tables.open_buckets(spark, path, base.schema).where("v <> 'old'")) == [(5, "last"), (5000, "new")]


def test_insert_of_many_rows_asks_a_bloom_filter(spark, plan, monkeypatch):
    monkeypatch.setattr(tables, "BROADCAST_ROWS", 10)
    base = spark.range(0, 5000, 2).select("id", F.lit("old").alias("v"))
    new = spark.range(1000).select("id", F.lit("new").alias("v"))
    found = tables.insert_if_absent(base, new, ["id"], ["v"])
    assert "bitmap_construct_agg" in plan(found)
    assert sorted(map(tuple, found.groupBy("v").count().collect())) == [("new", 500), ("old", 2500)]
    # None of the base keys asked for is lost, and few others pass.
    few = tables._maybe_held(spark.range(100_000), ["id"], spark.range(0, 100_000, 100), 1000)
    ids = {row.id for row in few.collect()}
    assert set(range(0, 100_000, 100)) <= ids and len(ids) < 12_000


def test_match_contains_many_lengths(spark, plan):
    """Reference codes of 1000 lengths that begin and end alike, and none, one and two letters long ones."""
    rng = random.Random(7)
    refs = ["".join(rng.choice("ab") for _ in range(3)) + "same" * (n // 4) + "xyz"[: n % 4] + str(n) for n in range(1000)] + ["q", "zz", None]
    codes = [None, "", "q", "zzz", "none"] + [f"<{rng.choice(refs[:1000])}{rng.choice(refs[:1000])}>" for _ in range(60)]
    order = {ref: rng.random() for ref in refs}
    reference = spark.createDataFrame([(ref, order[ref]) for ref in refs], "ref string, place double")
    found = joins.match_contains(spark.createDataFrame([(c,) for c in codes], "code string"), reference, "code", "ref", "place")
    want = []
    for code in codes:
        held = [ref for ref in refs if ref is not None and code is not None and ref in code]
        want.append((code, min(held, key=order.get) if held else None))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)
    # An empty reference is in every code.
    empty = joins.match_contains(spark.createDataFrame([("a",), ("",)], "code string"), reference.limit(0).union(spark.createDataFrame([("", 1.0)])), "code", "ref", "place")
    assert sorted(map(tuple, empty.collect())) == [("", ""), ("a", "")]


def test_a_key_with_many_rows_is_not_sorted(spark, dims, rows, plan, monkeypatch):
    """Above the limit rows pass hash tables of the dimension, also those of one name that is unknown."""
    facts = spark.range(0, 3000, 1, 3).select(F.when(F.col("id") == 7, "X").otherwise("nobody").alias("entity_name"), "id")
    monkeypatch.setitem(joins.keyed_side.__kwdefaults__, "limit", 0)
    found = joins.resolve_sub_sub_program(facts, dims)
    assert "ShuffledHashJoin" in plan(found) and "SortMergeJoin [entity_name" not in plan(found)
    assert rows(found) == [("X", 7, 100, 100, 100, 101, 100)]
