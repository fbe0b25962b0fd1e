"""Tables made of parts, each replaced as a whole by one small write.

A part (a source, a bucket of keys) lies below ``<path>/<column>=<part>/load=<id>``.
New files are written beside those that count, under a load id of their own; a
row in ``<path>/_switches`` then names the load of each part. It is one file,
which is there or not: a job that dies before leaves every reader with what was
there, and one that is run again adds a load of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SWITCHES = "seq long, part string, load string"


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def _switches(spark: SparkSession, path: str) -> DataFrame:
    where = f"{path.rstrip('/')}/_switches"
    return spark.read.schema(_SWITCHES).json(where) if exists(spark, where) else spark.createDataFrame([], _SWITCHES)


def new_load() -> str:
    return uuid.uuid4().hex


def current(spark: SparkSession, path: str) -> dict[str, str]:
    """The load that counts, by part; as many as there are parts."""
    latest = _switches(spark, path).groupBy("part").agg(F.max_by("load", "seq").alias("load"))
    return {row.part: row.load for row in latest.collect()}


def switch(spark: SparkSession, path: str, loads: Mapping[str, str]) -> None:
    """From now on these loads count; all of them, or none if the write fails."""
    seq = (_switches(spark, path).agg(F.max("seq")).first()[0] or 0) + 1
    rows = spark.createDataFrame([(seq, part, load) for part, load in loads.items()], _SWITCHES)
    rows.coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/_switches")


def part_path(path: str, column: str, part: str, load: str) -> str:
    return f"{path.rstrip('/')}/{column}={part}/load={load}"


def open_parts(
    spark: SparkSession, path: str, schema: T.StructType, column: str, loads: Mapping[str, str], only: Sequence[str] | None = None
) -> DataFrame:
    """The rows of the given loads, with the part as a column; ``only`` names the parts to read."""
    chosen = [part_path(path, column, part, load) for part, load in sorted(loads.items()) if only is None or part in only]
    if not chosen:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*chosen).drop("load")


def drop_replaced(spark: SparkSession, path: str, column: str, loads: Mapping[str, str]) -> int:
    """Delete the files of loads that count no more (readers opened before would miss them); how many loads went."""
    jvm, gone = spark.sparkContext._jvm, 0
    for part, load in loads.items():
        folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{column}={part}")
        system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in system.listStatus(folder) if system.exists(folder) else []:
            if status.getPath().getName() != f"load={load}":
                system.delete(status.getPath(), True)
                gone += 1
    return gone
