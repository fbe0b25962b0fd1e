"""CSV and text-list readers and writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.fixed_values import MISSING_TEXTS
from spendlake.functions import scalars as S
from spendlake.sources.records import csv_records, fields_in, header_names, parsed


_MISFIT = "_misfit"


def _raw_csv(spark: SparkSession, path: str | list[str]) -> tuple[list[str], DataFrame]:
    """The headers, and per record its fields as text, the record itself and its place.

    Every file is checked for the header of the first one.
    """
    header, records = csv_records(spark, path)
    headers = header_names(header) if header else []
    numbered = [f"_{n}" for n in range(len(headers))]
    other = F.raise_error(F.concat(F.lit("another header than the first file's in "), F.col("file")))
    same = parsed(F.col("header"), numbered).eqNullSafe(parsed(F.lit(header or ""), numbered)) & (fields_in(F.col("header")) == len(headers))
    rows = records.where(F.when(F.col("header").isNull(), True).when(same, False).otherwise(other.cast("boolean")))
    return headers, rows.select(
        parsed(F.col("record"), numbered).alias("_fields"), F.col("record").alias(_MISFIT), F.struct("file", "block", F.col("pos").alias("line")).alias("_place")
    )


def _surplus(headers: Sequence[str]) -> Column:
    return fields_in(F.col(_MISFIT)) > len(headers)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    *,
    skip_surplus: bool = False,
    order: str | None = None,
) -> DataFrame:
    """A CSV with a header line.

    Types are declared, not inferred: with a schema its columns are picked by
    trimmed header and converted, bad text being an error. Without one every
    column comes as text under its raw header. A row with missing fields has
    nulls there. A row with surplus fields is an error, or with
    ``skip_surplus`` left to ``csv_rejects``. A quoted field may hold line
    breaks, and a file is still read in splits. ``order`` names a further
    column that sorts the rows by file and place in it.
    """
    headers, raw = _raw_csv(spark, path)
    fields = [F.col(f"_fields._{n}").alias(name) for n, name in enumerate(headers)]
    if skip_surplus:
        raw = raw.where(~_surplus(headers))
    else:
        error = F.raise_error(F.concat(F.lit("more fields than headers: "), F.col(_MISFIT)))
        raw = raw.where(F.when(_surplus(headers), error.cast("boolean")).otherwise(True))
    if schema is None:
        columns = [S.missing_to_null(name, MISSING_TEXTS).alias(name) for name in headers]
    else:
        spelled = {name.strip(): name for name in headers}
        columns = [_typed(spelled[field.name], field).alias(field.name) for field in schema.fields]
    rows = raw.select(*fields, F.col("_place"))
    return rows.select(*columns, *([F.col("_place").alias(order)] if order else []))


def csv_rejects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The records that ``read_csv`` does not take, with the reason."""
    headers, raw = _raw_csv(spark, path)
    return raw.where(_surplus(headers)).select(F.lit("more fields than headers").alias("reason"), F.col(_MISFIT).alias("line"))


def _place() -> Column:
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def _typed(header: str, field: T.StructField) -> Column:
    filled = S.missing_to_null(header, MISSING_TEXTS)
    return filled if isinstance(field.dataType, T.StringType) else S.number(filled, field.dataType)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines of text files with ``ord``, which sorts them by file and place in it."""
    return spark.read.text(path).select(F.col("value").alias("line"), _place().alias("ord"))


def write_sorted_csv(df: DataFrame, keys: Sequence[str], path: str) -> str:
    """Rows in key order with a header; part files in name order hold the whole order.

    The sort is a range shuffle, so a long list stays spread over tasks, while
    adaptive execution merges a short one into a single file. Rows of equal key
    are ordered by the other columns, so a hot key is spread too.
    """
    others = [S.named(name) for name in df.columns if name not in keys]
    df.orderBy(*keys, *others).write.mode("overwrite").option("header", True).csv(path)
    return path
