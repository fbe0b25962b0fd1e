"""Totals and shares over the fact table, or over its sums.

Node and year filters reach the scan as partition and row-group filters, and
facts are summed by state before a dimension name is joined, so only one row
per state and node moves. Every report takes the facts or the far smaller table
of their sums by node, state and year that a load leaves next to them
(``ingest.open_sums``), and gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.fixed_values import CONTINUOUS_SIGN_UP, TOTAL_CRP
from spendlake.operators.filters import for_node, years
from spendlake.operators.joins import ENTITY_IDS, Dimensions, small_side, with_name
from spendlake.operators.ordering import rank_report


# What a sum of stored payments has room for.
_SUM = T.DecimalType(24, 2)


def node_sums(facts: DataFrame) -> DataFrame:
    """Payments summed by node of every level, state and year: sums can be summed on, so all reports can start from here."""
    return facts.groupBy(*ENTITY_IDS, "state_code", "year").agg(F.sum("payment").alias("payment"))


def _paid(df: DataFrame, value: Column | None = None) -> Column:
    """The sum of payments, of one type for facts and for sums of them."""
    total = F.sum(F.col("payment") if value is None else value)
    return total.cast(_SUM) if df.schema["payment"].dataType == _SUM else total


def register_views(facts: DataFrame, dims: Dimensions) -> None:
    """Temporary views of the facts (``payments``) and every dimension, for reports written in SQL."""
    facts.createOrReplaceTempView("payments")
    for name in Dimensions.__dataclass_fields__:
        getattr(dims, name).createOrReplaceTempView(name)


def total(facts: DataFrame, level: str, node_id: int, first: int, last: int) -> DataFrame:
    """One number: all payments of a node over a span of years."""
    return years(for_node(facts, level, node_id), first, last).agg(_paid(facts).alias("total_payments"))


def state_totals(facts: DataFrame, level: str, node_id: int, first: int, last: int) -> DataFrame:
    """Payments of a node by state, largest first."""
    chosen = years(for_node(facts, level, node_id), first, last)
    sums = chosen.groupBy(F.col("state_code").alias("state")).agg(_paid(facts).alias("total_payments"))
    return rank_report(sums, "total_payments")


def state_share(
    facts: DataFrame,
    dimension: DataFrame,
    level: str,
    node_id: int,
    first: int,
    last: int,
    bounded: bool = True,
) -> DataFrame:
    """Payments of a node by state and their share of the national total of the span.

    With ``bounded`` the state sums keep to the span too. Without it they run
    over all years while the total does not; both sums then come from one scan.
    """
    key = f"{level}_id"
    chosen = for_node(facts, level, node_id)
    if bounded:
        chosen = years(chosen, first, last)
    in_span = F.when(F.col("year").between(first, last), F.col("payment"))
    sums = chosen.groupBy(key, "state_code").agg(
        _paid(facts).alias("_dollars"),
        _paid(facts, None if bounded else in_span).alias("_in_span"),
    )
    # The window holds one row per state of the one node, not the facts.
    national = F.sum("_in_span").over(Window.partitionBy(key))
    shares = sums.withColumn("_national", national)
    report = with_name(shares, dimension, key, f"{level}_name").select(
        F.col("state_code").alias("state"),
        f"{level}_name",
        F.col("_dollars").alias("total_payment_in_dollars"),
        F.round(F.col("_dollars") / F.col("_national") * 100, 2).alias("total_payment_in_percentage_nationwide"),
    )
    return rank_report(report, "total_payment_in_percentage_nationwide")


def leaf_rows(
    facts: DataFrame,
    sub_programs: DataFrame,
    rollups: Sequence[str] = (TOTAL_CRP, CONTINUOUS_SIGN_UP),
) -> DataFrame:
    """Facts without the rows that repeat the sum of other rows."""
    summed = sub_programs.where(F.col("name").isin(list(rollups))).select(F.col("id").alias("_rollup_id"))
    repeats = (F.col("sub_program_id") == F.col("_rollup_id")) & F.col("sub_sub_program_id").isNull()
    return facts.join(small_side(summed), repeats, "left_anti")


def program_state_totals(
    facts: DataFrame,
    programs: DataFrame,
    node_id: int | None,
    first: int,
    last: int,
    leaf_sub_programs: DataFrame | None = None,
) -> DataFrame:
    """Payments by state and program name; with ``leaf_sub_programs`` roll-up rows are left out."""
    chosen = years(facts, first, last)
    if node_id is not None:
        chosen = for_node(chosen, "program", node_id)
    if leaf_sub_programs is not None:
        chosen = leaf_rows(chosen, leaf_sub_programs)
    sums = chosen.groupBy("program_id", "state_code").agg(_paid(facts).alias("_payments"))
    report = (
        with_name(sums, programs, "program_id", "program_name")
        .groupBy(F.col("state_code").alias("state"), "program_name")
        .agg(F.sum("_payments").alias("total_payments"))
    )
    return rank_report(report, "total_payments")
