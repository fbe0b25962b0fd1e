"""Fact appends, sources replaced as a whole, and keyed table changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.functions import scalars as S
from spendlake.operators.combine import first_by_key
from spendlake.operators.joins import BROADCAST_ROWS, small_side
from spendlake.session import scratch_path
from spendlake.sources import parts

# Bits of one row of a bitmap, as the built-in bitmap functions cut them.
_BITMAP_BITS = 32_768


def _spread(facts: DataFrame, partition: str) -> DataFrame:
    # Files of even size: rows of one partition value meet in few tasks, and a
    # value that holds too many rows is split over several at run time.
    return facts.hint("rebalance", partition)


def append_facts(facts: DataFrame, path: str, partition: str = "year") -> str:
    """Add rows to a fact table partitioned by year, in one bulk write."""
    _spread(facts, partition).write.mode("append").partitionBy(partition).parquet(path)
    return path


def stage_source(facts: DataFrame, path: str, source: str, load: str, partition: str = "year") -> None:
    """Write the rows of one source beside those that count."""
    _spread(facts, partition).write.mode("overwrite").partitionBy(partition).parquet(parts.part_path(path, "source", source, load))


def replace_source(facts: DataFrame, path: str, source: str, partition: str = "year") -> str:
    """Put rows in place of what a source held; a repeated load changes nothing, one that dies leaves the former rows."""
    load = parts.new_load()
    stage_source(facts, path, source, load, partition)
    parts.switch(facts.sparkSession, path, {source: load})
    return path


def open_sources(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows that count, with their source; ``schema`` names the columns of the table."""
    full = T.StructType([*schema.fields, T.StructField("source", T.StringType())])
    return parts.open_parts(spark, path, full, "source", parts.current(spark, path))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """A batch computed once, however often it is used."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Base rows with those of ``updates`` in place of equal keys; the last update in ``order`` wins.

    A small batch of updates is broadcast, so the base is not shuffled for it.
    For a base that is itself a stored table, see ``upsert_into``.
    """
    keys = list(keys)
    last = _stored(first_by_key(updates, keys, [F.desc(name) for name in order]), "updates")
    kept = base.join(small_side(last.select(*keys)), keys, "left_anti")
    return kept.unionByName(last.select(*[S.named(name) for name in base.columns]))


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[S.named(key) for key in keys]), F.lit(buckets)).cast("int")


def _write_buckets(rows: DataFrame, path: str, keys: Sequence[str], buckets: int, load: str) -> None:
    rows = rows.withColumns({"bucket": _bucket(keys, buckets), "load": F.lit(load)})
    _spread(rows, "bucket").write.mode("append").partitionBy("bucket", "load").parquet(path)


def lay_out(base: DataFrame, path: str, keys: Sequence[str], buckets: int) -> str:
    """Store a table in buckets of its keys, so that a batch of changes rewrites the buckets it touches and no others."""
    load = parts.new_load()
    _write_buckets(base, path, keys, buckets, load)
    parts.switch(base.sparkSession, path, {str(bucket): load for bucket in range(buckets)})
    return path


def _open_buckets(spark: SparkSession, path: str, schema: T.StructType, only: Sequence[str] | None = None) -> DataFrame:
    # A bucket without rows has no files.
    loads = parts.current(spark, path)
    loads = {bucket: load for bucket, load in loads.items() if parts.exists(spark, parts.part_path(path, "bucket", bucket, load))}
    full = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    return parts.open_parts(spark, path, full, "bucket", loads, only).select(*[S.named(name) for name in schema.names])


def open_buckets(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a table in buckets."""
    return _open_buckets(spark, path, schema)


def upsert_into(spark: SparkSession, path: str, schema: T.StructType, updates: DataFrame, keys: Sequence[str], order: Sequence[str]) -> int:
    """Change a table in buckets in place; how many buckets were written.

    The batch is computed and its last row per key chosen once. Only buckets
    with a key of the batch are read and written, the others keep their files;
    one small write makes all new buckets count at once.
    """
    keys = list(keys)
    buckets = len(parts.current(spark, path))
    last = _stored(first_by_key(updates, keys, [F.desc(name) for name in order]), "updates")
    touched = sorted(str(row.bucket) for row in last.select(_bucket(keys, buckets).alias("bucket")).distinct().collect())
    if touched:
        held = _open_buckets(spark, path, schema, touched)
        kept = held.join(small_side(last.select(*keys)), keys, "left_anti")
        load = parts.new_load()
        _write_buckets(kept.unionByName(last.select(*[S.named(name) for name in schema.names])), path, keys, buckets, load)
        parts.switch(spark, path, {bucket: load for bucket in touched})
    return len(touched)


def _maybe_held(rows: DataFrame, keys: Sequence[str], probe: DataFrame, count: int) -> DataFrame:
    """Rows that may have a key of ``probe``: a Bloom filter of one hash, 16 to 32 bits a key and 32 MB at most."""
    bits = min(1 << (16 * count - 1).bit_length(), 1 << 28)
    place = F.pmod(F.xxhash64(*[S.named(key) for key in keys]), F.lit(bits))
    number, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    filled = probe.groupBy(number.alias("_number")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << n) for n in range(8)]), (bit % 8).cast("int") + 1)) != 0
    return rows.withColumn("_number", number).join(F.broadcast(filled), "_number").where(met).drop("_number", "_bits")


def insert_if_absent(base: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Base rows and those new ones whose key it lacks; the first of equal new keys counts.

    The new side is computed once. The base is only read for the keys of the new
    side: they are sent to it if few, and if many a Bloom filter of them is, so
    that only base keys that may be among them are shuffled.
    """
    keys = list(keys)
    first = _stored(first_by_key(new, keys, order), "new-rows")
    count = first.count()
    asked, held = first.select(*keys), base.select(*keys)
    if count <= BROADCAST_ROWS:
        held = held.join(F.broadcast(asked), keys, "left_semi")
    else:
        held = _maybe_held(held, keys, asked, count).join(asked, keys, "left_semi")
    # As few as the new rows, or fewer.
    added = first.join(held.distinct(), keys, "left_anti")
    return base.unionByName(added.select(*[S.named(name) for name in base.columns]))
