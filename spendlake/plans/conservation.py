"""Conservation payments: practice rows, grouped reserve tables and easements."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake import fixed_values as V
from spendlake.operators.columns import (
    map_reverse,
    recode,
    rename_synonyms,
    scale,
    tag_entity,
    title_case,
    trim_columns,
    trim_headers,
    whole_year,
)
from spendlake.operators.combine import union_missing
from spendlake.operators.filters import failing, has_value, passing
from spendlake.operators.reshape import stack_groups


def _rules(df: DataFrame, first: int, last: int, names: Mapping[str, str]) -> dict[str, Column]:
    return {
        "year out of range": F.col("year").between(first, last),
        "amount missing": has_value(df, "amount"),
        "unknown state": F.col("state_name").isin(list(names.values())),
    }


def _practice_rows(df: DataFrame, columns: Mapping[str, str], labels: Mapping[str, str]) -> DataFrame:
    named = trim_columns(rename_synonyms(trim_headers(df), columns), ["practice_code"])
    return whole_year(recode(named, "practice_category", labels))


def practice_payments(
    df: DataFrame,
    entity_name: str,
    first: int,
    last: int,
    *,
    columns: Mapping[str, str] = V.CONSERVATION_COLUMNS,
    labels: Mapping[str, str] = V.CONSERVATION_LABELS,
    names: Mapping[str, str] = V.NAME_BY_CODE,
) -> DataFrame:
    """Payments by practice for one program."""
    rows = _practice_rows(df, columns, labels)
    kept = passing(rows, _rules(rows, first, last, names))
    return map_reverse(tag_entity(kept, entity_name, "program"), "state_name", names, "state_code")


def practice_rejects(
    df: DataFrame,
    first: int,
    last: int,
    *,
    columns: Mapping[str, str] = V.CONSERVATION_COLUMNS,
    labels: Mapping[str, str] = V.CONSERVATION_LABELS,
    names: Mapping[str, str] = V.NAME_BY_CODE,
) -> DataFrame:
    rows = _practice_rows(df, columns, labels)
    return failing(rows, _rules(rows, first, last, names))


def _reserve_rows(
    df: DataFrame,
    groups: Sequence[tuple[str, str, str]],
    measures: Mapping[str, str],
    columns: Mapping[str, str],
) -> DataFrame:
    stacked = stack_groups(trim_headers(df), ["year", "state"], groups, measures)
    return whole_year(title_case(rename_synonyms(scale(stacked, "amount", 1000), columns), "state_name"))


def reserve_payments(
    df: DataFrame,
    first: int,
    last: int,
    *,
    groups: Sequence[tuple[str, str, str]] = V.RESERVE_GROUPS,
    measures: Mapping[str, str] = V.RESERVE_MEASURES,
    columns: Mapping[str, str] = V.CONSERVATION_COLUMNS,
    names: Mapping[str, str] = V.NAME_BY_CODE,
) -> DataFrame:
    """One row per state, year and sign-up group out of the grouped wide table."""
    rows = _reserve_rows(df, groups, measures, columns)
    kept = passing(rows, _rules(rows, first, last, names))
    return map_reverse(kept, "state_name", names, "state_code")


def reserve_rejects(
    df: DataFrame,
    first: int,
    last: int,
    *,
    groups: Sequence[tuple[str, str, str]] = V.RESERVE_GROUPS,
    measures: Mapping[str, str] = V.RESERVE_MEASURES,
    columns: Mapping[str, str] = V.CONSERVATION_COLUMNS,
    names: Mapping[str, str] = V.NAME_BY_CODE,
) -> DataFrame:
    rows = _reserve_rows(df, groups, measures, columns)
    return failing(rows, _rules(rows, first, last, names))


def _easement_rows(
    df: DataFrame, columns: Mapping[str, str], labels: Mapping[str, str], recode_before_trim: bool
) -> DataFrame:
    named = rename_synonyms(trim_headers(df), columns)
    if recode_before_trim:
        named = recode(named, "state_name", labels)
    named = trim_columns(named, ["state_name"])
    return whole_year(named if recode_before_trim else recode(named, "state_name", labels))


def easement_payments(
    df: DataFrame,
    entity_name: str,
    first: int,
    last: int,
    *,
    columns: Mapping[str, str] = V.CONSERVATION_COLUMNS,
    labels: Mapping[str, str] = V.CONSERVATION_LABELS,
    names: Mapping[str, str] = V.NAME_BY_CODE,
    recode_before_trim: bool = False,
) -> DataFrame:
    """Easement and partnership payments, given in thousands.

    State labels are trimmed before they are recoded, so a label spelled with a
    trailing blank is not recoded and its rows drop out; ``recode_before_trim``
    keeps them.
    """
    rows = _easement_rows(df, columns, labels, recode_before_trim)
    kept = passing(rows, _rules(rows, first, last, names))
    coded = map_reverse(tag_entity(kept, entity_name, "program"), "state_name", names, "state_code")
    return scale(coded, "amount", 1000)


def easement_rejects(
    df: DataFrame,
    first: int,
    last: int,
    *,
    columns: Mapping[str, str] = V.CONSERVATION_COLUMNS,
    labels: Mapping[str, str] = V.CONSERVATION_LABELS,
    names: Mapping[str, str] = V.NAME_BY_CODE,
    recode_before_trim: bool = False,
) -> DataFrame:
    rows = _easement_rows(df, columns, labels, recode_before_trim)
    return failing(rows, _rules(rows, first, last, names))


def conservation_union(*frames: DataFrame) -> DataFrame:
    """All conservation payments; a column a source lacks is null in its rows."""
    return union_missing(*frames)
