"""Keys and data checks. Each check gives the violating rows; none means it passes."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.functions import scalars as S
from spendlake.operators.ordering import with_position


def _any_null(columns: Sequence[str]) -> Column:
    result = F.lit(False)
    for name in columns:
        result = result | S.named(name).isNull()
    return result


def _counted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*[S.named(name) for name in columns]).agg(F.count(F.lit(1)).alias("row_count"))


def check_pk(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that are null in part or occur more than once."""
    empty = _any_null(columns)
    reason = F.when(empty, "null key").when(F.col("row_count") > 1, "duplicate key")
    return _counted(df, columns).withColumn("reason", reason).where("reason IS NOT NULL")


def check_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, a null being different from every other value."""
    return _counted(df.where(~_any_null(columns)), columns).where("row_count > 1")


def check_fk(df: DataFrame, column: str, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose value is not null and not a key of the dimension."""
    parents = dimension.select(S.named(key).alias("_parent"))
    filled = df.where(S.named(column).isNotNull())
    return filled.join(parents, S.named(column) == F.col("_parent"), "left_anti")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(_any_null(columns))


def check_length(df: DataFrame, column: str, longest: int) -> DataFrame:
    return df.where(F.length(S.named(column)) > longest)


def misfit(column: Column, precision: int, scale: int) -> Column:
    """True where a value does not fit the decimal type after rounding to its scale.

    A comparison, since a cast that fails in many rows is slow.
    """
    wide = S.to_decimal(column, 38, scale, strict=False)
    return column.isNotNull() & (wide.isNull() | (F.abs(wide) >= F.lit(Decimal(10) ** (precision - scale))))


def check_precision(df: DataFrame, column: str, precision: int, scale: int) -> DataFrame:
    return df.where(misfit(S.named(column), precision, scale))


def assign_ids(df: DataFrame, *order: str | Column, start: int = 100, out: str = "id") -> DataFrame:
    """Consecutive ids in seed order."""
    numbered = with_position(df, *order, start=start, out=out)
    return numbered.select(F.col(out).cast("int").alias(out), *[S.named(name) for name in df.columns])
