"""Commodity payments: year-wide program tables, dairy and disaster rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake import fixed_values as V
from spendlake.functions.scalars import is_in
from spendlake.operators.columns import (
    map_reverse,
    recode_all,
    rename_synonyms,
    to_numeric,
    trim_columns,
    trim_headers,
    whole_year,
)
from spendlake.operators.combine import union_all
from spendlake.operators.filters import keep_in, keep_not_in
from spendlake.operators.joins import combine_measures
from spendlake.operators.reshape import wide_rejects, wide_to_long
from spendlake.schemas import SOURCE_NUMBER


def clean(df: DataFrame, columns: Mapping[str, str] = V.COMMODITY_COLUMNS) -> DataFrame:
    named = rename_synonyms(trim_headers(df), columns)
    return trim_columns(named, ["practice_code", "state_name"])


def arc_plc_payments(
    payments: Mapping[str, DataFrame],
    base_acres: Mapping[str, DataFrame],
    recipients: Mapping[str, DataFrame],
    first: int,
    last: int,
    *,
    columns: Mapping[str, str] = V.COMMODITY_COLUMNS,
    codes: Mapping[str, str] = V.CODE_BY_NAME,
    types: Mapping[str, Sequence[str]] = V.ENTITY_TYPES,
) -> DataFrame:
    """Payments of each entity with its base acres and recipients, one row per state and year.

    Each argument maps an entity name to its year-wide table.
    """

    def long(frames: Mapping[str, DataFrame], kind: str) -> DataFrame:
        return union_all(
            *[
                wide_to_long(clean(frame, columns), first, last, entity, kind, codes=codes, types=types)
                for entity, frame in frames.items()
            ]
        )

    return combine_measures(
        long(payments, "Total Payment"), long(base_acres, "Base Acres"), long(recipients, "Payee Count")
    )


def arc_plc_rejects(
    *tables: Mapping[str, DataFrame],
    columns: Mapping[str, str] = V.COMMODITY_COLUMNS,
    codes: Mapping[str, str] = V.CODE_BY_NAME,
) -> DataFrame:
    """State names of all year-wide tables that ``arc_plc_payments`` leaves out, with the reason."""
    frames = [frame for group in tables for frame in group.values()]
    return union_all(*[wide_rejects(clean(frame, columns), codes) for frame in frames])


def _dairy_disaster(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    named = whole_year(clean(df, columns))
    return to_numeric(named, ["amount", "recipient_count"], SOURCE_NUMBER)


def _labelled(
    df: DataFrame, entity_type: str, labels: Mapping[str, str], names: Mapping[str, str]
) -> DataFrame:
    coded = recode_all(df, labels).withColumn("entity_type", F.lit(entity_type))
    return map_reverse(coded, "state_name", names, "state_code")


def dairy_payments(
    df: DataFrame,
    *,
    columns: Mapping[str, str] = V.COMMODITY_COLUMNS,
    dairy: Sequence[str] = V.DAIRY_LABELS,
    labels: Mapping[str, str] = V.COMMODITY_LABELS,
    names: Mapping[str, str] = V.NAME_BY_CODE,
) -> DataFrame:
    """Dairy rows, paid at subtitle level. All years and states stay; an unknown state has no code."""
    return _labelled(keep_in(_dairy_disaster(df, columns), "entity_name", dairy), "subtitle", labels, names)


def disaster_payments(
    df: DataFrame,
    *,
    columns: Mapping[str, str] = V.COMMODITY_COLUMNS,
    dairy: Sequence[str] = V.DAIRY_LABELS,
    labels: Mapping[str, str] = V.COMMODITY_LABELS,
    names: Mapping[str, str] = V.NAME_BY_CODE,
) -> DataFrame:
    """All other rows of the same source, paid at program level."""
    return _labelled(keep_not_in(_dairy_disaster(df, columns), "entity_name", dairy), "program", labels, names)


def dairy_disaster_payments(
    df: DataFrame,
    *,
    columns: Mapping[str, str] = V.COMMODITY_COLUMNS,
    dairy: Sequence[str] = V.DAIRY_LABELS,
    labels: Mapping[str, str] = V.COMMODITY_LABELS,
    names: Mapping[str, str] = V.NAME_BY_CODE,
) -> DataFrame:
    """Dairy and disaster rows together, out of one scan of their source."""
    rows = _dairy_disaster(df, columns)
    at_subtitle = F.expr(is_in("entity_name", dairy))
    typed = rows.withColumn("entity_type", F.when(at_subtitle, "subtitle").otherwise("program"))
    return map_reverse(recode_all(typed, labels), "state_name", names, "state_code")
