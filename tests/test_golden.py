"""Published totals of the real source files.

The files are not part of this repository. ``SPENDLAKE_SOURCES`` names a JSON
file with the path of each source by its name (see ``spendlake.plans.ingest``),
plus ``practices``, ``national_lines`` and ``eqip_lines``.
"""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from spendlake import fixed_values as V
from spendlake.plans import conservation, reports
from spendlake.plans.dimensions import seed_dimensions, store_dimensions
from spendlake.plans.facts import check_dimensions, check_facts
from spendlake.plans.ingest import ingest, source_payments
from spendlake.plans.practices import parse_nested, practice_lists
from spendlake.sources.files import read_csv, read_lines

pytestmark = pytest.mark.skipif("SPENDLAKE_SOURCES" not in os.environ, reason="needs the real source files")
LISTS = ("practices", "national_lines", "eqip_lines")


@pytest.fixture(scope="module")
def paths():
    with open(os.environ["SPENDLAKE_SOURCES"]) as handle:
        return json.load(handle)


@pytest.fixture(scope="module")
def sources(spark, paths):
    return source_payments(spark, {name: path for name, path in paths.items() if name not in LISTS})


@pytest.fixture(scope="module")
def dims(spark, paths, tmp_path_factory):
    return store_dimensions(seed_dimensions(spark, read_csv(spark, paths["practices"])), str(tmp_path_factory.mktemp("d")))


@pytest.fixture(scope="module")
def facts(spark, paths, dims, tmp_path_factory):
    base = tmp_path_factory.mktemp("golden")
    given = {name: path for name, path in paths.items() if name not in LISTS}
    return ingest(spark, given, dims, str(base / "facts"), str(base / "rejects")).facts


def sums(df, *columns):
    rounded = [F.sum(F.round(name, places)).cast("string") for name, places in columns]
    return tuple(df.agg(F.count("*"), *rounded).first())


@pytest.mark.parametrize(
    ("entity", "amount", "recipients", "acre_rows", "acres"),
    [
        (V.ARC_CO, "17852587176.68", "2840402", 479, "1459836753.78"),
        (V.ARC_IC, "495072066.31", "56065", 0, None),
        (V.PLC, "17297949628.83", "2260620", 490, "955011696.82"),
    ],
)
def test_arc_plc(sources, entity, amount, recipients, acre_rows, acres):
    rows = sources["commodity"].where(F.col("entity_name") == entity)
    assert sums(rows, ("amount", 2), ("recipient_count", 0), ("base_acres", 2)) == (500, amount, recipients, acres)
    assert rows.where("base_acres IS NOT NULL").count() == acre_rows


@pytest.mark.parametrize(
    ("entity", "amount", "contracts", "acres"),
    [(V.ACEP, "3040719474.86", "2565", "179789.58"), (V.RCPP, "453830590.47", "179227", "15509401.92")],
)
def test_easements(sources, entity, amount, contracts, acres):
    rows = sources["conservation"].where(F.col("entity_name") == entity)
    assert sums(rows, ("amount", 2), ("contract_count", 0), ("base_acres", 2)) == (490, amount, contracts, acres)


def test_easement_rejects(spark, paths):
    for name in ("acep", "rcpp"):
        rejected = conservation.easement_rejects(read_csv(spark, paths[name]), 2014, 2023)
        assert [tuple(row) for row in rejected.groupBy("state_name").count().collect()] == [("Hawaii/Pacific", 10)]


def test_nutrition(sources):
    assert sums(sources["nutrition"], ("amount", 0), ("recipient_count", 0)) == (561, "881287446231", "461238008")
    assert sources["nutrition"].select("state_code").distinct().count() == 51


def test_practices(spark, paths, rows):
    national, eqip = read_lines(spark, paths["national_lines"]), read_lines(spark, paths["eqip_lines"])
    merged = practice_lists(national, eqip.limit(0), eqip).merged.where("source <> 'CSP'")
    stored = read_csv(spark, paths["practices"]).where("source <> 'CSP'")
    columns = ["practice_code", "practice_name", "source"]
    assert rows(merged, *columns) == rows(stored, *columns)
    assert rows(merged.groupBy("source").count()) == [("EQIP", 231), ("NRCS", 12)]
    assert parse_nested(eqip).count() > 0


def test_facts_and_reports(facts, dims):
    total = reports.total(facts, "title", 100, 2014, 2018).first()[0]
    assert str(total) == "26106184905.37"
    top = reports.state_totals(facts, "title", 100, 2014, 2021).limit(3).collect()
    assert [(row[0], str(row[1])) for row in top] == [
        ("TX", "3243123774.71"),
        ("NE", "2402208031.30"),
        ("AR", "2279853975.71"),
    ]
    for name, check in {**check_facts(facts, dims), **check_dimensions(dims)}.items():
        assert check.count() == 0, name
