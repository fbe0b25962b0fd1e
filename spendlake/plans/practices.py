"""Practice standards: three text lists to one list of codes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.fixed_values import EXTRA_PRACTICES
from spendlake.functions.parens import national_parts, nested_parts, paren_depth, simple_parts
from spendlake.functions.scalars import normalise_code
from spendlake.operators.combine import priority_merge, union_all
from spendlake.operators.joins import match_contains
from spendlake.operators.ordering import order_by_code
from spendlake.sources.files import write_sorted_csv
from spendlake.sources.literals import literal_relation

_MERGED = T.StructType([T.StructField(name, T.StringType()) for name in ("practice_code", "practice_name", "source")])


@dataclass(frozen=True)
class PracticeLists:
    """Lists sorted by code, national codes found in program codes, and lines that do not parse."""

    national: DataFrame
    csp: DataFrame
    eqip: DataFrame
    merged: DataFrame
    csp_matches: DataFrame
    eqip_matches: DataFrame
    rejects: DataFrame


def _parsed(lines: DataFrame, parts: Column) -> DataFrame:
    return lines.select("ord", "line", parts.alias("_parts"))


def _good(parsed: DataFrame) -> DataFrame:
    return parsed.where("_parts IS NOT NULL").select("ord", "_parts.*")


def parse_national(lines: DataFrame) -> DataFrame:
    """Lines ``name (unit) (code)``, in columns ``line`` and ``ord``."""
    return _good(_parsed(lines, national_parts(F.col("line"))))


def parse_simple(lines: DataFrame) -> DataFrame:
    """Lines ``name (code)``."""
    return _good(_parsed(lines, simple_parts(F.col("line"))))


def _nested(lines: DataFrame) -> DataFrame:
    measured = lines.withColumn("_depth", paren_depth(F.col("line")))
    return _parsed(measured, nested_parts(F.col("line"), F.col("_depth")))


def parse_nested(lines: DataFrame) -> DataFrame:
    """Lines ``name (code)`` whose code may hold parentheses."""
    return _good(_nested(lines))


def nested_rejects(lines: DataFrame) -> DataFrame:
    """Lines without parentheses or with unbalanced ones."""
    return _nested(lines).where("_parts IS NULL").select("ord", "line")


def _first_codes(parsed: DataFrame) -> DataFrame:
    return parsed.select("ord", normalise_code(F.col("practice_code")).alias("practice_code"), "practice_name")


def merge_lists(national: DataFrame, csp: DataFrame, eqip: DataFrame) -> DataFrame:
    """One row per code: the EQIP name if there is one, else the CSP name, else the national one."""
    return priority_merge(
        [
            (_first_codes(eqip), "EQIP"),
            (_first_codes(csp), "CSP"),
            (national.select("ord", "practice_code", "practice_name"), "NRCS"),
        ],
        ["practice_code"],
        ["ord"],
    ).drop("ord")


def _rejected(lines: DataFrame, parts: Column, source: str) -> DataFrame:
    return _parsed(lines, parts).where("_parts IS NULL").select(F.lit(source).alias("source"), "line")


def practice_lists(national: DataFrame, csp: DataFrame, eqip: DataFrame) -> PracticeLists:
    """All lists out of frames of lines with their order."""
    lines = {"NRCS": national, "CSP": csp, "EQIP": eqip}
    national, csp, eqip = parse_national(national), parse_nested(csp), parse_simple(eqip)
    extra = literal_relation(national.sparkSession, EXTRA_PRACTICES, _MERGED).select(
        "practice_code", "practice_name", "source"
    )
    merged = union_all(merge_lists(national, csp, eqip).select("practice_code", "practice_name", "source"), extra)
    rejected = union_all(
        _rejected(lines["NRCS"], national_parts(F.col("line")), "NRCS"),
        nested_rejects(lines["CSP"]).select(F.lit("CSP").alias("source"), "line"),
        _rejected(lines["EQIP"], simple_parts(F.col("line")), "EQIP"),
    )

    def matches(parsed: DataFrame) -> DataFrame:
        return match_contains(
            parsed.select("practice_code", "practice_name"), national, "practice_code", "practice_code", "ord"
        )

    return PracticeLists(
        national=order_by_code(national, ties=["ord"]).select("practice_name", "practice_unit", "practice_code"),
        csp=order_by_code(csp, ties=["ord"]).select("practice_code", "practice_name"),
        eqip=order_by_code(eqip, ties=["ord"]).select("practice_code", "practice_name"),
        merged=order_by_code(merged),
        csp_matches=matches(csp),
        eqip_matches=matches(eqip),
        rejects=rejected,
    )


def store_practice_lists(lists: PracticeLists, path: str) -> dict[str, str]:
    """Write the four lists as CSV in order of their codes; the folder of each by its name."""
    names = ("national", "csp", "eqip", "merged")
    base = path.rstrip("/")
    return {name: write_sorted_csv(getattr(lists, name), ["practice_code"], f"{base}/{name}") for name in names}
