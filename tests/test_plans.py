"""Every source layout from invented files to facts, rejects and reports."""

from __future__ import annotations

import csv
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixture_files import source_files
from spendlake import fixed_values as V
from spendlake import schemas
from spendlake.plans import commodity, conservation, reports
from spendlake.plans.dimensions import open_dimensions, seed_dimensions, store_dimensions
from spendlake.operators import joins
from spendlake.plans import facts as facts_module
from spendlake.plans import ingest as ingest_module
from spendlake.plans.facts import broken_rules, check_dimensions, check_facts, load_facts
from spendlake.plans.ingest import ingest, open_facts, open_rejects, open_sums, read_sources, source_payments
from spendlake.sources.files import csv_rejects, read_csv
from spendlake.sources.tables import stage_source


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    return source_files(tmp_path_factory.mktemp("sources"))


@pytest.fixture(scope="module")
def dims(spark, files, tmp_path_factory):
    seeded = seed_dimensions(spark, read_csv(spark, files["practices"]))
    return store_dimensions(seeded, str(tmp_path_factory.mktemp("dims")))


@pytest.fixture(scope="module")
def sources(spark, files):
    paths = {name: path for name, path in files.items() if name != "practices"}
    return source_payments(spark, paths, 2014, 2016, 2016)


@pytest.fixture(scope="module")
def loaded(spark, files, dims, tmp_path_factory):
    base = tmp_path_factory.mktemp("tables")
    paths = {name: path for name, path in files.items() if name != "practices"}
    table, rejects = str(base / "facts"), str(base / "rejects")

    def load():
        return ingest(spark, paths, dims, table, rejects, 2014, 2016, 2016)

    once = load()
    first = once.facts.groupBy("source").agg(F.count("*"), F.sum("payment")).collect()
    ids = {row.id for row in once.facts.select("id").collect()}
    # All further tests look at the second load of the same files.
    again = load()
    assert again.broken == {} and {row.id for row in again.facts.select("id").collect()} == ids
    return again.facts, again.rejects, first


def text(*names):
    return [F.col(name).cast("string") for name in names]


def test_read_csv_declared(spark, files):
    schema = schemas._struct(year=schemas.T.IntegerType(), payments=schemas.T.DoubleType(), state=schemas.T.StringType())
    df = read_csv(spark, files["dairy_disaster"], schema)
    assert df.columns == ["year", "payments", "state"]
    assert [row["payments"] for row in df.collect()][:3] == [100.5, None, 3.255]


def test_read_csv_text_and_missing(spark, files):
    df = read_csv(spark, files["dairy_disaster"])
    assert df.columns == [" state", "year", "program", "payments ", "count"]
    assert [row["count"] for row in df.collect()][:3] == ["2", None, None]


def test_bad_number_is_an_error(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("year,payments\n2014,12x\n")
    with pytest.raises(Exception, match="not a number"):
        read_csv(spark, str(tmp_path / "bad.csv"), schemas._struct(payments=schemas.T.DoubleType())).collect()


def test_arc_plc(sources, rows):
    frame = sources["commodity"].where(F.col("entity_name").isin(V.ARC_CO, V.ARC_IC, V.PLC))
    numbers = [F.col(name).cast("double") for name in ("amount", "base_acres", "recipient_count")]
    got = rows(frame.select("state_code", "year", *numbers))
    assert len(got) == 15
    assert ("AL", 2014, 10.01, 100.255, 3.0) in got
    assert ("IA", 2014, None, None, 6.0) in got
    assert ("IA", 2016, 6.5, None, 8.0) in got
    assert ("OH", 2014, 2.0, None, None) in got
    assert ("OH", 2016, 9.13, None, 6.0) in got


def test_dairy_and_disaster_keep_all_years_and_states(sources, rows):
    frame = sources["commodity"].where(~F.col("entity_name").isin(V.ARC_CO, V.ARC_IC, V.PLC))
    got = rows(frame.select("entity_type", "entity_name", "state_code", "year", *text("amount", "recipient_count")))
    assert got == sorted(
        [
            ("subtitle", V.SUBTITLE_D, "IA", 2013, "100.50000000", "2.00000000"),
            ("subtitle", V.SUBTITLE_D, "OH", 2014, None, None),
            ("subtitle", V.SUBTITLE_D, "OH", 2014, "3.25500000", None),
            ("program", V.LFP, None, 2014, "7.00000000", "1.00000000"),
            ("program", V.ELAP, "TX", 2015, "8.00000000", "1.00000000"),
            ("program", V.NAP, "TX", 2015, "9.00000000", "1.00000000"),
            ("program", V.TAP, "TX", 2015, "9.00000000", "3.00000000"),
        ],
        key=repr,
    )


def test_dairy_and_disaster_apart_are_the_same_rows(spark, files, rows):
    raw = read_csv(spark, files["dairy_disaster"])
    both = commodity.dairy_disaster_payments(raw)
    apart = commodity.dairy_payments(raw).unionByName(commodity.disaster_payments(raw))
    assert rows(both, *sorted(both.columns)) == rows(apart, *sorted(both.columns))
    assert commodity.dairy_payments(raw).count() == 3


def test_disaster_text_that_is_no_number_fails(spark):
    df = spark.createDataFrame([("Iowa", "2014", "LFP", "1,000", "1")], ["state", "year", "program", "payments", "count"])
    with pytest.raises(Exception, match="not a number"):
        commodity.disaster_payments(df).collect()


def test_practice_payments(sources, rows):
    frame = sources["conservation"].where(F.col("entity_name") == V.EQIP)
    assert rows(frame.select("state_code", "practice_category", "practice_code", *text("amount"))) == sorted(
        [
            ("IA", "Land Management", "E340A", "1.00500000"),
            ("IA", "Soil Remediation", "B000CPL24", "2.00000000"),
            ("IA", "Other Improvement", "340", "2.00000000"),
            ("IA", None, None, "3.00000000"),
            ("OH", "Structural", "E999X", "6.00000000"),
        ],
        key=repr,
    )


def test_practice_rejects(spark, files, rows):
    rejected = conservation.practice_rejects(read_csv(spark, files["eqip"]), 2014, 2016)
    assert rows(rejected, "reason") == [("amount missing",), ("unknown state",), ("year out of range",)]


def test_reserve_payments(sources, rows):
    frame = sources["conservation"].where(F.col("entity_type").like("sub%"))
    # The district is spelled differently in title case, so it drops out.
    assert rows(frame.groupBy("state_code").count()) == [("IA", 6), ("NY", 7)]
    crep = frame.where("entity_name = 'CREP Only' AND state_code = 'NY'").first()
    assert crep["amount"] == Decimal("4123.45") and crep["entity_type"] == "sub_sub_program"
    assert (crep["contract_count"], crep["farm_count"], crep["base_acres"]) == (13, 23, Decimal("3.5"))


def test_reserve_rejects(spark, files, rows):
    rejected = conservation.reserve_rejects(read_csv(spark, files["crp"]), 2014, 2016)
    assert rows(rejected.groupBy("reason").count()) == [
        ("amount missing", 1),
        ("unknown state", 14),
        ("year out of range", 7),
    ]


def test_easements_trim_before_recoding(spark, files, sources, rows):
    frame = sources["conservation"].where(F.col("entity_name") == V.ACEP)
    assert rows(frame.select("state_code", *text("amount"))) == [("AK", "577123.45000000")]
    raw = read_csv(spark, files["acep"])
    kept = conservation.easement_payments(raw, V.ACEP, 2014, 2016, recode_before_trim=True)
    assert rows(kept, "state_code") == [("AK",), ("HI",)]
    rejected = conservation.easement_rejects(raw, 2014, 2016)
    assert rows(rejected, "state_name", "reason") == [
        ("Hawaii/Pacific", "unknown state"),
        ("Iowa", "amount missing"),
        ("Iowa", "year out of range"),
    ]


def test_nutrition(sources, rows):
    frame = sources["nutrition"].where("year = 2014")
    assert rows(frame.select("state_code", "entity_type", *text("amount", "recipient_count"))) == [
        ("DC", "program", "1.00", None),
        ("IA", "program", "10.00", "438558.83330000"),
    ]


def test_insurance_keeps_unknown_states_for_the_load(sources, rows):
    assert rows(sources["insurance"], "state_code", "year") == [("IA", 2014), ("PR", 2015), ("XX", 2015)]


def test_seeds(dims, rows):
    counts = {name: getattr(dims, name).count() for name in dims.__dataclass_fields__}
    assert counts == {
        "states": 52,
        "titles": 4,
        "subtitles": 3,
        "programs": 13,
        "sub_programs": 6,
        "sub_sub_programs": 3,
        "practice_categories": 28,
        "practices": 3,
    }
    assert rows(dims.programs.where("id IN (100, 105, 111)"), "id", "title_id", "subtitle_id", "name") == [
        (100, 100, 100, V.ARC),
        (105, 100, 102, V.TAP),
        (111, 102, None, V.SNAP),
    ]
    assert rows(dims.sub_programs.where("id = 104"), "program_id", "name") == [(108, V.CONTINUOUS_SIGN_UP)]
    assert rows(dims.sub_sub_programs, "id", "sub_program_id") == [(100, 104), (101, 104), (102, 104)]
    assert rows(dims.practices, "code", "display_name")[1] == ("340", "Cover Crop (340)")


def test_seeds_pass_their_checks(dims):
    assert {name: check.count() for name, check in check_dimensions(dims).items() if check.count()} == {}


def test_seeding_again_changes_nothing(spark, files, dims, rows):
    again = seed_dimensions(spark, read_csv(spark, files["practices"]), existing=dims)
    for name in dims.__dataclass_fields__:
        assert rows(getattr(again, name)) == rows(getattr(dims, name)), name


def test_seeding_adds_what_is_missing(spark, files, dims, rows):
    from dataclasses import replace

    partial = replace(dims, programs=dims.programs.where("id <> 102"))
    again = seed_dimensions(spark, read_csv(spark, files["practices"]), {V.TITLE_NUTRITION: "x"}, partial)
    assert rows(again.programs.where(F.col("name") == V.ELAP), "id") == [(113,)]


def test_load(loaded, rows):
    facts, rejected, _ = loaded
    counts = dict(rows(facts.groupBy("source").count()))
    assert (counts["crop_insurance"], counts["snap"], counts["arc_plc"] + counts["dairy_disaster"]) == (2, 6, 20)
    assert sum(counts[name] for name in ("eqip", "csp", "crp", "acep", "rcpp") if name in counts) == 20
    at_load = rejected.where("step = 'load'")
    assert rows(at_load.groupBy("reason").count()) == [
        ("state code missing", 1),
        ("unknown entity name", 1),
        ("unknown practice category", 1),
        ("unknown practice code", 1),
        ("unknown state code", 1),
    ]


def test_cleaning_rejects_are_loaded_with_their_reason(spark, files, loaded, rows):
    _, rejected, _ = loaded
    cleaned = rejected.where("step = 'cleaning'")
    assert rows(cleaned.where("source = 'eqip'"), "reason") == [("amount missing",), ("unknown state",), ("year out of range",)]
    assert rows(cleaned.where("source = 'crp'").groupBy("reason").count()) == [
        ("amount missing", 1), ("unknown state", 14), ("year out of range", 7)
    ]
    # Every row read is a fact or a reject.
    for name in ("eqip", "acep", "crop_insurance"):
        read = read_csv(spark, files[name]).count()
        kept = loaded[0].where(F.col("source") == name).count()
        assert kept + rejected.where(F.col("source") == name).count() == read, name


def test_sources_loaded_one_after_another_stay(spark, files, dims, tmp_path, rows):
    table, rejects = str(tmp_path / "facts"), str(tmp_path / "rejects")
    for name in ("eqip", "crp", "crop_insurance"):
        result = ingest(spark, {name: files[name]}, dims, table, rejects, 2014, 2016, 2016)
    assert [name for name, _ in rows(result.facts.groupBy("source").count())] == ["crop_insurance", "crp", "eqip"]
    assert result.facts.select("id").distinct().count() == result.facts.count() and result.broken == {}


def test_a_source_of_rejects_only(spark, dims, tmp_path, files):
    header = open(files["crop_insurance"]).readline()
    (tmp_path / "none.csv").write_text(header)
    result = ingest(spark, {"crop_insurance": str(tmp_path / "none.csv")}, dims, str(tmp_path / "f"), str(tmp_path / "r"), 2014, 2016, 2016)
    assert result.facts.count() == 0 and result.rejects.count() == 0


def test_unknown_names_and_sources_in_part_are_errors(spark, files):
    with pytest.raises(ValueError, match="unknown source files: eqqip"):
        read_sources(spark, {"eqqip": files["eqip"]})
    with pytest.raises(ValueError, match="snap lacks the files snap_participation"):
        read_sources(spark, {"snap_costs": files["snap_costs"]})


def test_rows_of_equal_key_have_ids_of_their_own(spark, dims):
    payments = spark.createDataFrame(
        [("program", V.PLC, "IA", 2014, 1.0)] * 3 + [("program", V.PLC, "IA", 2015, 1.0)],
        "entity_type string, entity_name string, state_code string, year int, amount double",
    )
    facts, _ = load_facts(payments, dims, "x")
    assert facts.select("id").distinct().count() == 4
    # Another source has other ids for the same rows.
    other, _ = load_facts(payments, dims, "y")
    assert facts.join(other, "id").count() == 0


def test_ids_do_not_depend_on_the_layout(spark, dims):
    """Unique keys, keys with several contents, and rows equal in everything, some of them thousands of times."""
    values = [("program", V.PLC, "IA", 2014, 1.0)] * 25_000 + [("program", V.PLC, "IA", 2014, 2.0)] * 3
    values += [("program", V.PLC, "IA", 2015 + n % 2, float(n)) for n in range(40)] + [("program", V.PLC, "OH", 2014, 1.0)]
    payments = spark.createDataFrame(values, "entity_type string, entity_name string, state_code string, year int, amount double")
    found = []
    for parts in (1, 7):
        facts, _ = load_facts(payments.repartition(parts), dims, "x")
        found.append(sorted((row.id, row.year, row.payment) for row in facts.select("id", "year", "payment").collect()))
    assert found[0] == found[1] and len(found[0]) == len(values) == len({row[0] for row in found[0]})


def test_ids_do_not_depend_on_how_many_keys_repeat(spark, dims, plan, monkeypatch):
    """Many repeated keys take one shuffle of the rows, few are sent to the rows: the ids are the same."""
    values = [("program", V.PLC, "IA", 2014, 1.0)] * 21_000 + [("program", V.PLC, "IA", 2015 + n % 2, float(n // 4)) for n in range(40)]
    values += [("program", V.PLC, "OH", 2014, 1.0)] * 3 + [("program", V.PLC, "OH", 2015, 1.0), ("program", "nobody", "OH", 2015, 1.0)]
    payments = spark.createDataFrame(values, "entity_type string, entity_name string, state_code string, year int, amount double")
    found = []
    for limit in (200_000, 0):
        monkeypatch.setattr(facts_module, "BROADCAST_ROWS", limit)
        monkeypatch.setitem(joins.keyed_side.__kwdefaults__, "limit", limit)
        facts, _ = load_facts(payments, dims, "x")
        found.append(sorted((row.id, row.state_code, row.year, row.payment) for row in facts.collect()))
    assert found[0] == found[1] and len(found[0]) == len(values) - 1 == len({row[0] for row in found[0]})
    # Keys in few rows: of the rows there is one shuffle, by their key.
    facts, _ = load_facts(payments.where("year > 2014"), dims, "x")
    wide = [line for line in plan(facts).splitlines() if "Exchange hashpartitioning(_key" in line]
    assert len(wide) in (1, 2) and "SortMergeJoin [_key" not in plan(facts)


def test_a_load_sorts_no_rows_of_an_unknown_name(spark, dims, plan, monkeypatch):
    payments = spark.createDataFrame([("program", "nobody", "IA", 2014, 1.0)], "entity_type string, entity_name string, state_code string, year int, amount double")
    entities = joins.entity_dimension(dims)
    monkeypatch.setitem(joins.keyed_side.__kwdefaults__, "limit", 0)
    for given in (None, entities):
        judged = facts_module.judge_payments(payments, dims, given)
        assert "SortMergeJoin [entity_type" not in plan(judged) and "ShuffledHashJoin [entity_type" in plan(judged)
        assert [row.reason for row in judged.collect()] == ["unknown entity name"]


def test_facts_without_a_lower_level_are_spread(spark, dims, plan, monkeypatch):
    """In the check of a large dimension absent values do not meet in one task, and count as before."""
    title, program = (dims.programs.where(F.col("name") == V.PLC).select(name).first()[0] for name in ("title_id", "id"))
    values = [(1, title, program, None, "IA", 2014), (2, title, program, 0, "IA", 2015), (3, title, -1, None, "IA", 2016), (4, title, None, None, "XYZ", 2014)]
    spoiled = spark.createDataFrame(values, "id long, title_id int, program_id int, sub_program_id int, state_code string, year int")
    absent = [field for field in schemas.PAYMENTS.fields if field.name not in spoiled.columns]
    spoiled = spoiled.withColumns({field.name: F.lit(None).cast(field.dataType) for field in absent})
    monkeypatch.setattr(facts_module, "BROADCAST_ROWS", 0)
    found = broken_rules(spoiled, dims)
    text = plan(found)
    assert {row.rule: row.broken for row in found.collect()} == {
        "program_id known": 1, "sub_program_id known": 1, "state_code known": 1, "state_code length": 1
    }
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert not any("hashpartitioning(sub_program_id" in line for line in shuffles) and any("spread" in line for line in shuffles)


def test_broken_rules_are_those_of_the_single_checks(spark, dims, loaded, plan):
    facts = loaded[0].drop("source")
    first = facts.limit(1)
    spoiled = facts.unionByName(first).unionByName(first.withColumn("state_code", F.lit("XYZ")).withColumn("id", F.lit(None).cast("long")))
    spoiled = spoiled.unionByName(first.withColumns({"year": F.lit(None).cast("int"), "program_id": F.lit(-1), "practice_code": F.lit("q" * 101)}))
    want = {name: check.count() for name, check in check_facts(spoiled, dims).items()}
    found = broken_rules(spoiled, dims)
    assert {row.rule: row.broken for row in found.collect()} == {name: n for name, n in want.items() if n} and len(want) == 14
    assert broken_rules(facts, dims).count() == 0
    text = plan(broken_rules(loaded[0], dims))
    assert text.count("payment") == 0 and text.count("hashpartitioning(rule") == 2


def test_a_load_that_dies_leaves_rows_and_rejects(spark, files, dims, tmp_path, monkeypatch):
    table, rejects = str(tmp_path / "facts"), str(tmp_path / "rejects")
    given = {name: files[name] for name in ("snap_costs", "snap_participation")}
    before = ingest(spark, given, dims, table, rejects, 2014, 2016, 2016)
    held = sorted(map(str, before.facts.collect())), sorted(map(str, before.rejects.collect()))
    dead = F.raise_error(F.lit("dead")).cast("string")
    for target in ("_reject_rows", "stage_source"):
        with monkeypatch.context() as m:
            if target == "_reject_rows":
                m.setattr(ingest_module, target, lambda rows, step: rows.select(*[dead.alias(name) for name in ("step", "reason", "row")]).union(spark.createDataFrame([("a", "b", "c")], "step string, reason string, row string").withColumn("row", dead)))
            else:
                m.setattr(ingest_module, target, lambda facts, *where: stage_source(facts.withColumn("payment", dead.cast("decimal(14,2)")), *where))
            with pytest.raises(Exception, match="dead"):
                ingest(spark, given, dims, table, rejects, 2014, 2016, 2016)
        now = open_facts(spark, table), open_rejects(spark, table, rejects)
        assert (sorted(map(str, now[0].collect())), sorted(map(str, now[1].collect()))) == held


def test_reports_from_sums_equal_those_from_facts(spark, files, dims, tmp_path, plan, rows):
    table = str(tmp_path / "facts")
    given = {name: files[name] for name in ("snap_costs", "snap_participation", "crop_insurance")}
    for _ in range(2):
        facts = ingest(spark, given, dims, table, str(tmp_path / "rejects"), 2014, 2016, 2016).facts
    sums = open_sums(spark, table)
    kinds = [
        lambda df: reports.total(df, "title", 102, 2014, 2016),
        lambda df: reports.state_totals(df, "title", 102, 2014, 2015),
        lambda df: reports.state_share(df, dims.titles, "title", 102, 2014, 2015),
        lambda df: reports.state_share(df, dims.titles, "title", 102, 2014, 2014, bounded=False),
        lambda df: reports.program_state_totals(df, dims.programs, None, 2014, 2016, leaf_sub_programs=dims.sub_programs),
    ]
    for report in kinds:
        assert report(sums).schema == report(facts).schema and rows(report(sums)) == rows(report(facts)) != []
    text = plan(reports.state_totals(sums, "title", 102, 2014, 2015))
    assert text.count("FileScan") == 1 and "payment:decimal(24,2)" in text


def test_load_types(loaded):
    facts, _, _ = loaded
    kinds = {field.name: field.dataType for field in schemas.PAYMENTS}
    assert {field.name: field.dataType for field in facts.schema if field.name != "source"} == kinds


def test_load_values(loaded, rows):
    facts, _, _ = loaded
    eqip = facts.where("program_id = 106 AND practice_code_variant IS NOT NULL")
    assert rows(eqip, "practice_category_id", "practice_code", "practice_code_variant") == [
        (100, "340", "E340A"),
        (103, "000", "B000CPL24"),
    ]
    snap = facts.where("program_id = 111 AND state_code = 'IA'").orderBy("year").collect()
    assert [row["recipient_count"] for row in snap] == [438559, 3, 3]
    insurance = facts.where("program_id = 112 AND state_code = 'IA'").first()
    assert (insurance["indemnity_amount"], insurance["loss_ratio"]) == (50, Decimal("0.5"))
    crep = facts.where("sub_sub_program_id = 100 AND state_code = 'NY'").first()
    assert (crep["title_id"], crep["program_id"], crep["sub_program_id"]) == (101, 108, 104)
    # Dairy is stored at subtitle level, rounded to cents.
    dairy = facts.where("subtitle_id = 101 AND payment IS NOT NULL").orderBy("year").collect()
    assert [(row["program_id"], row["payment"]) for row in dairy] == [(None, Decimal("100.50")), (None, Decimal("3.26"))]


def test_load_again_replaces(loaded, rows):
    facts, _, first = loaded
    assert rows(facts.groupBy("source").agg(F.count("*"), F.sum("payment"))) == sorted(map(tuple, first), key=repr)


def test_loaded_facts_pass_their_checks(loaded, dims):
    broken = {name: check.count() for name, check in check_facts(loaded[0], dims).items()}
    assert {name: count for name, count in broken.items() if count} == {}


def test_unknown_and_oversized_rows_are_rejected_not_lost(spark, dims, rows):
    payments = spark.createDataFrame(
        [
            ("program", V.PLC, "IA", 2014, 1e13),
            ("program", V.PLC, "IA", None, 1.0),
            ("unknown", V.PLC, "IA", 2014, 1.0),
            ("sub_program", V.ARC_CO, "IA", 2014, float("nan")),
            (None, None, "IA", 2014, 1.0),
        ],
        "entity_type string, entity_name string, state_code string, year int, amount double",
    )
    facts, rejected = load_facts(payments, dims)
    assert rows(facts, "sub_program_id", "payment") == [(100, None)]
    assert rows(rejected, "reason") == [
        ("payment too large",),
        ("unknown entity type",),
        ("unknown entity type",),
        ("year missing",),
    ]


def test_reports_over_loaded_facts(loaded, dims, rows):
    facts = loaded[0]
    assert rows(reports.total(facts, "title", 100, 2014, 2015).select(*text("total_payments"))) == [("58.27",)]
    totals = reports.state_totals(facts, "subtitle", 100, 2014, 2016).collect()
    assert [(r["state"], str(r["total_payments"])) for r in totals] == [("OH", "30.13"), ("AL", "15.01"), ("IA", "14.50")]


FACTS = [
    ("AK", 2014, 100, 50, "60.00"),
    ("AK", 2020, 100, 50, "30.00"),
    ("AL", 2014, 100, 50, "40.00"),
    ("AL", 2014, 101, 51, "1000.00"),
    ("TX", 2020, 100, 50, "5.00"),
    ("WY", 2015, 100, 50, None),
]


@pytest.fixture(scope="module")
def few_facts(spark):
    df = spark.createDataFrame(FACTS, "state_code string, year int, title_id int, program_id int, payment string")
    return df.withColumn("payment", F.col("payment").cast("decimal(14,2)"))


def test_share_bounded_and_open(spark, few_facts):
    titles = spark.createDataFrame([(100, "T")], "id int, name string")

    def share(bounded):
        report = reports.state_share(few_facts, titles, "title", 100, 2014, 2015, bounded)
        return [tuple(None if v is None else str(v) for v in row) for row in report.collect()]

    assert share(True) == [
        ("WY", "T", None, None),
        ("AK", "T", "60.00", "60.00"),
        ("AL", "T", "40.00", "40.00"),
    ]
    assert share(False) == [
        ("WY", "T", None, None),
        ("AK", "T", "90.00", "90.00"),
        ("AL", "T", "40.00", "40.00"),
        ("TX", "T", "5.00", "5.00"),
    ]


def test_totals_put_null_first_and_sum_nothing_to_null(few_facts):
    assert [r["state"] for r in reports.state_totals(few_facts, "title", 100, 2014, 2015).collect()] == ["WY", "AK", "AL"]
    assert reports.total(few_facts, "title", 999, 2014, 2015).first()[0] is None


def test_program_totals(spark, few_facts, rows):
    programs = spark.createDataFrame([(50, "P"), (51, "P")], "id int, name string")
    all_programs = reports.program_state_totals(few_facts, programs, None, 2014, 2015)
    assert rows(all_programs.select("state", "program_name", *text("total_payments"))) == [
        ("AK", "P", "60.00"),
        ("AL", "P", "1040.00"),
        ("WY", "P", None),
    ]
    one = reports.program_state_totals(few_facts, programs, 51, 2014, 2015)
    assert rows(one, "state") == [("AL",)]


def test_storing_dimensions_where_they_are_read_from(spark, files, dims, tmp_path, rows):
    path = str(tmp_path / "dims")
    first = store_dimensions(dims, path)
    again = store_dimensions(seed_dimensions(spark, read_csv(spark, files["practices"]), existing=open_dimensions(spark, path)), path)
    for name in dims.__dataclass_fields__:
        assert rows(getattr(again, name)) == rows(getattr(first, name)), name
    assert rows(again.titles.where("description IS NULL")) == []


def test_last_line_of_a_practice_code_wins(spark, tmp_path, rows):
    from spendlake.plans.dimensions import seed_practices

    (tmp_path / "list.csv").write_text("practice_code,practice_name,source\n384,Zeta,X\n385,Beta,X\n384,Alpha,X\n")
    merged = read_csv(spark, str(tmp_path / "list.csv"), order="ord")
    assert rows(seed_practices(merged), "code", "name") == [("384", "Alpha"), ("385", "Beta")]


def test_csv_rows_that_do_not_fit_their_header(spark, tmp_path, rows):
    from spendlake.sources.files import csv_rejects

    one, two = tmp_path / "one.csv", tmp_path / "two.csv"
    one.write_text('a,b\n1,"x ""y"" z"\n3,4,5\n6\n')
    assert rows(read_csv(spark, str(one), skip_surplus=True)) == [("1", 'x "y" z'), ("6", None)]
    assert rows(csv_rejects(spark, str(one)), "line") == [("3,4,5",)]
    with pytest.raises(Exception, match="more fields than headers"):
        read_csv(spark, str(one)).collect()
    two.write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, [str(one), str(two)], skip_surplus=True).collect()


def test_dimension_tables_open_again(spark, dims, tmp_path, rows):
    store_dimensions(dims, str(tmp_path))
    assert rows(open_dimensions(spark, str(tmp_path)).titles, "id") == [(100,), (101,), (102,), (103,)]


def test_reports_in_sql(spark, loaded, dims):
    reports.register_views(loaded[0], dims)
    share = spark.sql(
        """SELECT state_code AS state, subtitles.name AS subtitle_name, sum(payment) AS total_payment_in_dollars,
                  round(sum(payment) / (SELECT sum(payment) FROM payments
                                        WHERE subtitle_id = 100 AND year BETWEEN 2014 AND 2015) * 100, 2)
                  AS total_payment_in_percentage_nationwide
           FROM payments JOIN subtitles ON payments.subtitle_id = subtitles.id
           WHERE subtitle_id = 100 GROUP BY state_code, subtitles.name
           ORDER BY total_payment_in_percentage_nationwide DESC NULLS FIRST"""
    )
    built = reports.state_share(loaded[0], dims.subtitles, "subtitle", 100, 2014, 2015, bounded=False)
    assert share.collect() == built.collect() and len(built.collect()) == 3


def multiline_files(folder, count, rows, seed):
    """Files as a CSV writer makes them, with quotes, commas and breaks of both kinds in fields, and their rows in order."""
    rng = random.Random(seed)
    held = []
    for file in range(count):
        with open(folder / f"f{file}.csv", "w", newline="") as handle:
            writer = csv.writer(handle, lineterminator=rng.choice(["\n", "\r\n"]))
            writer.writerow(["id", "t,x", "u"])
            for n in range(rows):
                cells = ["".join(rng.choice(["x", '"', ",", "\n", "\r\n", " ", "y", '""']) for _ in range(rng.choice([0, 1, 9]))) for _ in range(2)]
                writer.writerow([f"{file}-{n}", *cells])
                held.append((f"{file}-{n}", cells[0] or None, cells[1] or None))
    return held


@pytest.mark.parametrize("split", ["40", "300", "1m"])
def test_read_csv_breaks_in_fields_across_splits(spark, tmp_path, split):
    want = multiline_files(tmp_path, 2, 60, int(len(split)))
    before = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = [tuple(row[:3]) for row in read_csv(spark, str(tmp_path), order="ord").orderBy("ord").collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert got == want


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n" + '1,"x\ny"\n2,z\n' * 20_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        rows = read_csv(spark, str(tmp_path / "one.csv"))
        assert spark.read.text(str(tmp_path / "one.csv")).rdd.getNumPartitions() >= 8
        assert {tuple(row) for row in rows.groupBy("a", "b").count().collect()} == {("1", "x\ny", 20_000), ("2", "z", 20_000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_read_csv_odd_files(spark, tmp_path):
    good, other, unclosed, split_head, empty = (tmp_path / name for name in ("good", "other", "unclosed", "head", "empty"))
    # A blank line, a quote inside of a field that does not begin with one, a missing field, no line feed at the end.
    good.write_text('\na,b\n\n5" pipe,x\n"p ""q""",\n" \n ",y\n7')
    assert sorted(map(tuple, read_csv(spark, str(good)).collect()), key=repr) == sorted([('5" pipe', "x"), ('p "q"', None), (" \n ", "y"), ("7", None)], key=repr)
    other.write_text("a,c\n1,2\n")
    with pytest.raises(Exception, match="another header"):
        read_csv(spark, [str(good), str(other)]).collect()
    unclosed.write_text('a,b\n1,"x\n2,y\n')
    with pytest.raises(ValueError, match="not closed in .*unclosed"):
        read_csv(spark, str(unclosed))
    split_head.write_text('a,"b\nc"\n1,2\n')
    with pytest.raises(ValueError, match="header goes over several lines"):
        read_csv(spark, str(split_head))
    empty.write_text("a,b\n")
    assert read_csv(spark, str(empty)).count() == 0
    (tmp_path / "surplus").write_text('a,b\n1,"x,\n,y",z\n2,y\n')
    assert [row.line for row in csv_rejects(spark, str(tmp_path / "surplus")).collect()] == ['1,"x,\n,y",z']
    assert [tuple(row) for row in read_csv(spark, str(tmp_path / "surplus"), skip_surplus=True).collect()] == [("2", "y")]


def test_plain_files_are_not_shuffled(spark, plan, tmp_path):
    (tmp_path / "plain.csv").write_text("a,b\n" + "1,2\n" * 100)
    assert "hashpartitioning" not in plan(read_csv(spark, str(tmp_path / "plain.csv")))
