"""Practice lists from text files to the merged list."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from spendlake.plans.practices import practice_lists
from spendlake.sources.files import read_lines, write_sorted_csv

NATIONAL = [
    "Cover Crop (Ac.) (340)",
    "",
    "Seeding (Ac.) (384)",
    "Seeding again (Ac.) (384)",
    "Sealing - Clay (soil) (Ft2) (520)",
    "No unit (999)",
]
CSP = [
    "Crop Bundle (21 - Crop Bundle (Organic))",
    "Enhancement (E340A)",
    "Second enhancement (E340B)",
    "New practice (777Z)",
    "Open (ended",
    "No code",
]
EQIP = ["Cover (plain) (340)", "Cover later (B340X)", "Odd Code (XYZ)"]


@pytest.fixture(scope="module")
def lists(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("lists")
    frames = []
    for name, lines in (("national", NATIONAL), ("csp", CSP), ("eqip", EQIP)):
        path = folder / f"{name}.txt"
        path.write_text("\n".join(lines))
        frames.append(read_lines(spark, str(path)))
    return practice_lists(*frames)


def test_lines_keep_their_order(spark, tmp_path):
    lines = [f"line {n}" for n in range(3000)]
    (tmp_path / "a.txt").write_text("\n".join(lines))
    (tmp_path / "b.txt").write_text("last")
    got = [row["line"] for row in read_lines(spark, str(tmp_path)).orderBy("ord").collect()]
    assert got == [*lines, "last"]


def test_each_list_is_sorted_under_the_right_names(lists):
    assert [tuple(row) for row in lists.national.collect()] == [
        ("Cover Crop", "Ac.", "340"),
        ("Seeding", "Ac.", "384"),
        ("Seeding again", "Ac.", "384"),
        ("Sealing - Clay (soil)", "Ft2", "520"),
    ]
    assert [row["practice_code"] for row in lists.csp.collect()] == [
        "21 - Crop Bundle (Organic)",
        "777Z",
        "E340A",
        "E340B",
    ]
    assert [row["practice_code"] for row in lists.eqip.collect()] == ["340", "B340X", "XYZ"]


def test_merge_prefers_eqip_then_csp_then_national(lists):
    assert [tuple(row) for row in lists.merged.collect()] == [
        ("21 - Crop Bundle (Organic)", "Crop Bundle", "CSP"),
        ("340", "Cover (plain)", "EQIP"),
        ("384", "Seeding", "NRCS"),
        ("520", "Sealing - Clay (soil)", "NRCS"),
        ("777", "New practice", "CSP"),
        ("ERP", "Equitable Relief Payment", "CSP"),
        ("EUP", "Erroneous Underpayment", "CSP"),
        ("OTP", "Other Payment", "CSP"),
        ("XYZ", "Odd Code", "EQIP"),
    ]


def test_national_codes_inside_program_codes(lists, rows):
    assert rows(lists.csp_matches, "practice_code", "matched_code") == [
        ("21 - Crop Bundle (Organic)", None),
        ("777Z", None),
        ("E340A", "340"),
        ("E340B", "340"),
    ]
    assert rows(lists.eqip_matches, "practice_code", "matched_code") == [("340", "340"), ("B340X", "340"), ("XYZ", None)]


def test_lines_that_do_not_parse(lists, rows):
    assert rows(lists.rejects) == [("CSP", "No code"), ("CSP", "Open (ended"), ("NRCS", ""), ("NRCS", "No unit (999)")]


def test_sorted_csv_parts_hold_the_order(spark, lists, tmp_path):
    path = write_sorted_csv(lists.merged.repartition(4), ["practice_code"], str(tmp_path / "merged"))
    parts = sorted((tmp_path / "merged").glob("part-*.csv"))
    # A short list is one file; a long one would be several in name order.
    assert len(parts) == 1
    codes = [line.split(",")[0] for line in parts[0].read_text().splitlines()]
    assert codes == ["practice_code", *sorted(row["practice_code"] for row in lists.merged.collect())]
    assert spark.read.option("header", True).csv(path).count() == 9


def test_many_sorted_parts_still_hold_the_order(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(2000).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("k"))
        write_sorted_csv(df.repartition(5), ["k"], str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted((tmp_path / "out").glob("part-*.csv"))
    lines = [line for part in parts for line in part.read_text().splitlines() if line != "k"]
    assert len(parts) > 1 and lines == [f"{n:05d}" for n in range(2000)]
