"""Crop-insurance benefits, already one row per state code and year."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake import fixed_values as V
from spendlake.operators.columns import rename_synonyms, tag_entity, whole_year
from spendlake.operators.filters import failing, years


def insurance_benefits(
    df: DataFrame,
    first: int,
    last: int,
    *,
    entity_name: str = V.CROP_INSURANCE,
    columns: Mapping[str, str] = V.INSURANCE_COLUMNS,
) -> DataFrame:
    return tag_entity(rename_synonyms(years(whole_year(df), first, last), columns), entity_name, "program")


def insurance_rejects(df: DataFrame, first: int, last: int) -> DataFrame:
    """Rows that ``insurance_benefits`` leaves out, with the reason."""
    return failing(whole_year(df), {"year out of range": F.col("year").between(first, last)})
