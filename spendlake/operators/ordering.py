"""Sorted output and positions in a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlake.functions.scalars import named
from spendlake.session import shared_dir

_ROW_BITS = 33


def rank_report(df: DataFrame, measure: str) -> DataFrame:
    """Largest first, rows without a value in front; rows of equal value in order of their other columns."""
    return df.orderBy(F.desc_nulls_first(measure), *[named(name) for name in df.columns if name != measure])


def order_by_code(df: DataFrame, column: str = "practice_code", ties: Sequence[str] = ()) -> DataFrame:
    """Order by code as text; ``ties`` order rows of equal code, and let a hot one be split."""
    return df.orderBy(column, *ties)


def numbered(ordered: DataFrame, start: int = 1, out: str = "position") -> DataFrame:
    """Number rows in the order they are in, without gathering them in one task.

    The rows are written to the checkpoint folder, which fixes their split; each
    partition then numbers its own rows and adds the count of all earlier ones.
    Only one row per partition passes through the window.
    """
    shared_dir(ordered.sparkSession)
    marked = ordered.withColumn("_mark", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_mark", _ROW_BITS)
    within = F.col("_mark").bitwiseAND((1 << _ROW_BITS) - 1)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        marked.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    # One row per partition: small however large the data.
    placed = marked.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return placed.select(*ordered.columns, (F.col("_before") + within + start).cast("long").alias(out))


def with_position(df: DataFrame, *order: str | Column, start: int = 1, out: str = "position") -> DataFrame:
    """Sort by range and number the rows.

    All columns break ties: a value held by many rows spreads over partitions,
    and a task that runs again puts each row where it was.
    """
    ties = [named(name) for name in df.columns]
    return numbered(df.orderBy(*order, *ties), start, out)
