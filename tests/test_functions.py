"""Column expressions against plain Python on hand-picked and generated texts."""

from __future__ import annotations

import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.functions import scalars as S
from spendlake.functions.parens import national_parts, nested_parts, paren_depth, simple_parts


def evaluate(spark, values, make, kind="string"):
    """The value of a column expression for each input."""
    frame = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [row[1] for row in frame.select("i", make(F.col("v")).alias("r")).orderBy("i").collect()]


def test_strip_drops_every_white_space(spark):
    texts = [" a ", "\t\na b\r\n", "\xa0x　", "", None, "  "]
    assert evaluate(spark, texts, S.strip) == [None if t is None else t.strip() for t in texts]


def test_title_case(spark):
    texts = ["DISTRICT OF COLUMBIA", "new york", None]
    assert evaluate(spark, texts, S.title_case) == ["District Of Columbia", "New York", None]


def test_round2_is_half_up_in_decimal(spark):
    assert evaluate(spark, [1.005, 2.675, -1.005, None], S.round2, "double") == [
        Decimal("1.01"),
        Decimal("2.68"),
        Decimal("-1.01"),
        None,
    ]


def test_number_blank_is_null(spark):
    values = evaluate(spark, ["1.5", " 2 ", "", "  ", None, "2.5E3"], lambda c: S.number(c, T.DoubleType()))
    assert values == [1.5, 2.0, None, None, None, 2500.0]


def test_number_bad_text(spark):
    with pytest.raises(Exception, match="not a number"):
        evaluate(spark, ["12x"], lambda c: S.number(c, T.DoubleType()))
    assert evaluate(spark, ["12x"], lambda c: S.number(c, T.DoubleType(), strict=False)) == [None]


def test_nan_to_null(spark):
    assert evaluate(spark, [float("nan"), 1.0, None], S.nan_to_null, "double") == [None, 1.0, None]


def test_normalise_code(spark):
    codes = ["E340A", "B000CPL24", "1 - Irrigated", "OTP", "12 3456", "", None]
    expected = []
    for code in codes:
        found = re.search(r"\d{3}", code) if code else None
        expected.append(found.group() if found else code)
    assert evaluate(spark, codes, S.normalise_code) == expected


def test_display_name_is_null_if_a_part_is(spark):
    assert evaluate(spark, ["A", None], lambda c: S.display_name(F.lit("Name"), c)) == ["Name (A)", None]


def test_classify(spark):
    types = {"x": ["a", "b"], "y": ["c"]}
    assert evaluate(spark, ["a", "c", "z", None], lambda c: S.classify(c, types)) == ["x", "y", "unknown", "unknown"]
    assert evaluate(spark, ["a"], lambda c: S.classify(c, {})) == ["unknown"]


def test_look_up_takes_any_text(spark):
    table = {"it's": "back\\slash", "b": "c"}
    assert evaluate(spark, ["it's", "b", "q", None], lambda c: S.look_up(c, table)) == ["back\\slash", "c", None, None]


def expected_depth(line):
    open_now = deepest = 0
    for mark in re.findall(r"[()]", line):
        open_now = open_now + 1 if mark == "(" else max(open_now - 1, 0)
        deepest = max(deepest, open_now)
    return -1 if open_now else deepest


def up_to_close(text):
    return text.partition(")")[0].strip()


def expected_simple(line):
    head, found, tail = line.rpartition("(")
    return (head.strip(), up_to_close(tail)) if found else None


def expected_national(line):
    if line.count("(") < 2:
        return None
    head, _, code = line.rpartition("(")
    head, _, unit = head.rpartition("(")
    return head.strip(), up_to_close(unit), up_to_close(code)


def expected_nested(line):
    depth = expected_depth(line)
    if depth > 1:
        head, _, tail = line.partition("(")
        return head.strip(), tail.rpartition(")")[0].strip()
    return expected_simple(line) if depth == 1 else None


LINES = [
    "Access Control (Ac.) (472)",
    "Dam, Diversion (No.) (348)",
    "Pond Sealing or Lining - Clay (soil) (Ft2) (520)",
    "Crop Bundle (21 - Crop Bundle (Organic))",
    "Forest Bundle (1)",
    "Broken (open",
    "Stray) end (12)",
    "No code",
    "",
    "()",
    "(((",
    ")))",
    "a (b) c (d (e) f) g",
]


def generated_lines():
    source = random.Random(7)
    return ["".join(source.choices("ab 1()()", k=source.randint(0, 14))) for _ in range(400)]


@pytest.mark.parametrize(
    ("make", "expected"),
    [
        (paren_depth, expected_depth),
        (simple_parts, expected_simple),
        (national_parts, expected_national),
        (lambda c: nested_parts(c, paren_depth(c)), expected_nested),
    ],
    ids=["depth", "simple", "national", "nested"],
)
def test_parentheses(spark, make, expected):
    lines = LINES + generated_lines()
    got = evaluate(spark, lines, make)
    got = [tuple(value) if isinstance(value, tuple) else value for value in got]
    assert got == [expected(line) for line in lines]


def test_parentheses_far_into_a_long_line(spark):
    line = "x" * 50_000 + " (Ac.) (472)"
    assert tuple(evaluate(spark, [line], national_parts)[0])[1:] == ("Ac.", "472")
    assert evaluate(spark, ["(" * 3 + "y" * 50_000 + ")" * 3], paren_depth) == [3]


def test_look_up_finds_every_entry(spark):
    table = {f"key {n} é": n for n in range(300)}
    keys = [*table, "key 300 é", "", None]
    assert evaluate(spark, keys, lambda c: S.look_up(c, table)) == [table.get(key) for key in keys]
    numbers = {n: f"v{n}" for n in range(0, 90, 3)}
    rows = spark.range(100).select("id", S.look_up(F.col("id").cast("int"), numbers).alias("v")).collect()
    assert {row.id: row.v for row in rows if row.v} == numbers
