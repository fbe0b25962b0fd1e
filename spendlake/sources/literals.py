"""Relations from literal rows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def literal_relation(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A small local table; the planner knows its exact size."""
    columns = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(values, type=field.type) for values, field in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)
