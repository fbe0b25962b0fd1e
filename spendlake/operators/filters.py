"""Row filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.functions import scalars as S
from spendlake.operators.joins import small_side
from spendlake.session import scratch_path

LEVELS = ("title", "subtitle", "program", "sub_program", "sub_sub_program")


def years(df: DataFrame, first: int, last: int, column: str = "year") -> DataFrame:
    return df.where(S.named(column).between(first, last))


def has_value(df: DataFrame, column: str) -> Column:
    value = S.named(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return value.isNotNull() & ~F.isnan(value)
    return value.isNotNull()


def require(df: DataFrame, column: str) -> DataFrame:
    """Drop rows without a value."""
    return df.where(has_value(df, column))


def keep_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(S.is_in(column, values))


def keep_not_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """The complement of ``keep_in``: a null is in no set, so it stays."""
    return df.where(f"NOT coalesce({S.is_in(column, values)}, false)")


def exactly_once(df: DataFrame, keys: Sequence[str], bounded: bool = False) -> DataFrame:
    """Rows whose key occurs once.

    Only keys and their counts are shuffled, a key held by a third of all rows
    being one row per map task. The keys that repeat, as a rule few, are stored
    and then sent to the rows as a filter, so rows neither move nor are sorted
    for it; if they prove many, the rows are shuffled by key. ``bounded`` says
    that there can only be few different keys: then nothing is stored first.
    """
    spark = df.sparkSession
    held = {key: f"_key{n}" for n, key in enumerate(keys)}
    counted = df.groupBy(*[S.named(key).alias(held[key]) for key in keys]).agg(F.count(F.lit(1)).alias("_rows"))
    repeated = counted.where("_rows > 1").drop("_rows")
    if bounded:
        repeated = F.broadcast(repeated)
    else:
        path = scratch_path(spark, "repeated")
        repeated.write.parquet(path)
        repeated = small_side(spark.read.schema(repeated.schema).parquet(path))
    same = reduce(and_, [S.named(key).eqNullSafe(F.col(name)) for key, name in held.items()])
    return df.join(repeated, same, "left_anti")


def for_node(df: DataFrame, level: str, node_id: int) -> DataFrame:
    """Facts below one node of the program hierarchy."""
    if level not in LEVELS:
        raise ValueError(f"level must be one of {LEVELS}")
    return df.where(F.col(f"{level}_id") == node_id)


def passing(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows for which every rule holds; rules are named after what it means to fail them."""
    for rule in rules.values():
        df = df.where(rule)
    return df


def failing(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The complement of ``passing``, with the name of the first rule that fails as ``reason``."""
    checks = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(reason)) for reason, rule in rules.items()]
    return df.withColumn("reason", F.coalesce(*checks)).where("reason IS NOT NULL")
