"""Nutrition costs and participation, both year-wide by state code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from spendlake import fixed_values as V
from spendlake.operators.columns import map_forward, rename_synonyms, select_year_columns
from spendlake.operators.joins import combine_measures
from spendlake.operators.combine import union_all
from spendlake.operators.reshape import wide_rejects, wide_to_long


def _spelled(
    df: DataFrame, first: int, last: int, skip: str, key: str, columns: Mapping[str, str], names: Mapping[str, str]
) -> DataFrame:
    chosen = rename_synonyms(select_year_columns(df, key, first, last, [skip]), columns)
    return map_forward(chosen, "state_name", names)


def costs_participation(
    costs: DataFrame,
    participation: DataFrame,
    first: int,
    last: int,
    *,
    entity_name: str = V.SNAP,
    key: str = "State",
    columns: Mapping[str, str] = V.NUTRITION_COLUMNS,
    names: Mapping[str, str] = V.NAME_BY_CODE,
    types: Mapping[str, Sequence[str]] = V.ENTITY_TYPES,
) -> DataFrame:
    """Costs by state and year with the monthly average of participants."""
    codes = {name: code for code, name in names.items()}

    def long(df: DataFrame, skip: str, kind: str):
        spelled = _spelled(df, first, last, skip, key, columns, names)
        return wide_to_long(spelled, first, last, entity_name, kind, codes=codes, types=types)

    return combine_measures(long(costs, "Total", "Total Payment"), long(participation, "Avg.", "Payee Count"))


def costs_participation_rejects(
    costs: DataFrame,
    participation: DataFrame,
    first: int,
    last: int,
    *,
    key: str = "State",
    columns: Mapping[str, str] = V.NUTRITION_COLUMNS,
    names: Mapping[str, str] = V.NAME_BY_CODE,
) -> DataFrame:
    """State labels of both tables that are left out, with the reason."""
    codes = {name: code for code, name in names.items()}
    kinds = ((costs, "Total"), (participation, "Avg."))
    return union_all(*[wide_rejects(_spelled(df, first, last, skip, key, columns, names), codes) for df, skip in kinds])
