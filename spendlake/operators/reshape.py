"""Wide tables to long rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.fixed_values import CODE_BY_NAME, ENTITY_TYPES
from spendlake.functions import scalars as S
from spendlake.operators.filters import exactly_once, keep_in
from spendlake.schemas import SOURCE_NUMBER

# Kind of wide table -> column its values become.
MEASURES = {"Base Acres": "base_acres", "Payee Count": "recipient_count", "Total Payment": "amount"}


def wide_to_long(
    df: DataFrame,
    first: int,
    last: int,
    entity_name: str,
    kind: str,
    *,
    codes: Mapping[str, str] = CODE_BY_NAME,
    types: Mapping[str, Sequence[str]] = ENTITY_TYPES,
    number: T.DataType = SOURCE_NUMBER,
) -> DataFrame:
    """One row per state and year out of a table with a column per year.

    A state counts only if its name is known and stands in exactly one row.
    """
    measure = MEASURES[kind]
    spans = [str(year) for year in range(first, last + 1)]
    # Known names first: total rows, which may be out of range, never reach the
    # conversion, and what is left has at most one group per state.
    known = keep_in(df.selectExpr("state_name", *map(S.quoted, spans)), "state_name", list(codes))
    once = exactly_once(known, ["state_name"], bounded=True)
    typed = [f"CAST({S.quoted(year)} AS {number.simpleString()}) AS {S.quoted(year)}" for year in spans]
    rows = once.selectExpr("state_name", *typed).unpivot("state_name", spans, "year", measure)
    value = F.col(measure)
    if kind == "Total Payment":
        value = S.round2(value)
    return rows.select(
        S.look_up(F.col("state_name"), codes).alias("state_code"),
        F.col("year").cast("int").alias("year"),
        F.lit(entity_name).alias("entity_name"),
        F.lit(S.type_of(entity_name, types)).alias("entity_type"),
        value.alias(measure),
    )


def wide_rejects(df: DataFrame, codes: Mapping[str, str] = CODE_BY_NAME) -> DataFrame:
    """State names that ``wide_to_long`` leaves out, how often each occurs, and why."""
    known = F.coalesce(F.col("state_name").isin(list(codes)), F.lit(False))
    counted = df.groupBy("state_name").agg(F.count(F.lit(1)).alias("row_count"))
    reason = F.when(~known, "unknown state").when(F.col("row_count") > 1, "state occurs more than once")
    return counted.withColumn("reason", reason).where("reason IS NOT NULL")


def stack_groups(
    df: DataFrame,
    keys: Sequence[str],
    groups: Sequence[tuple[str, str, str]],
    measures: Mapping[str, str],
    separator: str = " - ",
) -> DataFrame:
    """Groups of columns to rows in one pass: each group is (header prefix, entity name, entity type)."""
    stacked = F.array(
        *[
            F.struct(
                F.lit(name).alias("entity_name"),
                F.lit(kind).alias("entity_type"),
                *[S.named(f"{prefix}{separator}{suffix}").alias(out) for suffix, out in measures.items()],
            )
            for prefix, name, kind in groups
        ]
    )
    return df.select(*[S.named(key) for key in keys], F.inline(stacked))
