"""Projection and cleaning of whole columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.functions import scalars as S
from spendlake.schemas import SOURCE_NUMBER


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def rename_synonyms(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by exact header, all at once, so swaps and chains of names are safe."""
    names = [mapping.get(name, name) for name in df.columns]
    doubled = sorted({name for name in names if names.count(name) > 1})
    if doubled:
        raise ValueError(f"several columns would be named {doubled}")
    return df.toDF(*names)


def trim_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Trim the values of those of ``columns`` that exist."""
    present = [name for name in columns if name in df.columns]
    return df.withColumns({name: S.strip(S.named(name)) for name in present})


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select([S.named(name) for name in columns])


def select_year_columns(df: DataFrame, key: str, first: int, last: int, skip: Iterable[str] = ()) -> DataFrame:
    """The key and the columns named after a year of the range."""
    other = {key, *skip}
    years = [name for name in df.columns if name not in other and first <= int(name) <= last]
    return select_columns(df, [key, *years])


def tag_entity(df: DataFrame, name: str, kind: str) -> DataFrame:
    return df.withColumns({"entity_type": F.lit(kind), "entity_name": F.lit(name)})


def scale(df: DataFrame, column: str, factor: int, kind: T.DecimalType = SOURCE_NUMBER) -> DataFrame:
    """Multiply in decimal; ``kind`` must hold every decimal the source gives."""
    return df.withColumn(column, S.named(column).cast(kind) * F.lit(factor))


def to_numeric(df: DataFrame, columns: Iterable[str], kind: T.DataType, strict: bool = True) -> DataFrame:
    return df.withColumns({name: S.number(S.named(name).cast("string"), kind, strict) for name in columns})


def whole_year(df: DataFrame, column: str = "year") -> DataFrame:
    """Years read as text become integers."""
    return df.withColumn(column, S.named(column).cast("int"))


def title_case(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, S.title_case(S.named(column)))


def recode(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace exact values of one column; others pass."""
    return df.replace(dict(mapping), subset=[column])


def recode_all(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Replace exact values in every text column."""
    texts = [field.name for field in df.schema.fields if isinstance(field.dataType, T.StringType)]
    return df.replace(dict(mapping), subset=texts)


def map_forward(df: DataFrame, column: str, mapping: Mapping[str, object], out: str | None = None) -> DataFrame:
    """Code to name through a short literal table; unmatched is null."""
    return df.withColumn(out or column, S.look_up(S.named(column), mapping))


def map_reverse(df: DataFrame, column: str, mapping: Mapping[str, str], out: str) -> DataFrame:
    """Name to code through the same table read backwards; the last of equal names wins."""
    return df.withColumn(out, S.look_up(S.named(column), {name: code for code, name in mapping.items()}))


def storage_value(column: Column, have: T.DataType, kind: T.DataType, strict: bool = False) -> Column:
    """Round half up to the storage type; too large is null, or an error when strict."""
    if have == kind:
        return column
    if isinstance(kind, T.IntegralType) and not isinstance(have, T.IntegralType):
        column = S.to_decimal(column, 20, 0, strict)
    return column.cast(kind) if strict else column.try_cast(kind)


def to_storage(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Bring the columns that ``schema`` knows to their storage types, keep the others."""
    kinds = {field.name: field.dataType for field in schema.fields}
    return df.select(
        [
            storage_value(S.named(field.name), field.dataType, kinds[field.name], strict).alias(field.name)
            if field.name in kinds
            else S.named(field.name)
            for field in df.schema.fields
        ]
    )


def project_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``: absent ones become null, NaN becomes null."""
    have = {field.name: field.dataType for field in df.schema.fields}

    def column(field: T.StructField) -> Column:
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = S.named(field.name)
        if isinstance(have[field.name], (T.DoubleType, T.FloatType)):
            value = S.nan_to_null(value)
        return storage_value(value, have[field.name], field.dataType).alias(field.name)

    return df.select([column(field) for field in schema.fields])
