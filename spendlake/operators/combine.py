"""Unions, first-per-key and keyed merges."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlake.functions import scalars as S


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def union_missing(*frames: DataFrame) -> DataFrame:
    """Stack unlike frames; a column a frame lacks is null in its rows."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in an explicit order.

    Spark keeps one row per key in every map task before the shuffle
    (window group limit), so a hot key costs no more than any other.
    """
    place = F.row_number().over(Window.partitionBy(*[S.named(key) for key in keys]).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def priority_merge(
    sources: Sequence[tuple[DataFrame, str]],
    keys: Sequence[str],
    order: Sequence[str],
    tag: str = "source",
) -> DataFrame:
    """One row per key from the earliest listed source that has it, first by ``order`` within it."""
    ranked = [
        frame.withColumns({tag: F.lit(label), "_rank": F.lit(rank)}) for rank, (frame, label) in enumerate(sources)
    ]
    return first_by_key(union_all(*ranked), keys, ["_rank", *order]).drop("_rank")
