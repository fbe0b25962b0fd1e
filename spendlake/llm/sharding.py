"""Even shards by histogram sort.

Rows are ordered by a 63-bit key: the checksum of the text, then a hash of the
id, so equal texts lie side by side and a large group of them can still be cut.
Probes are key boundaries. In each round the exact bytes and rows below every
probe are counted over all partitions, and the bins that hold a wanted splitter
are probed more finely, until each splitter is within the tolerance. Rows below
a splitter are known by then, so every row's place in its shard needs only its
place in a small key range. The documents move once.

Where several splitters are wanted inside the rows of one key (equal in id and
text, or null ids of one text), the rows are numbered and cut by number: each
partition numbers its own, and the counts of earlier partitions are added.

Defined results: a null text has no bytes of its own, like an empty one; a null
id is hashed like any value; rows equal in id and text are cut like any others;
an empty table has no shards; further columns move with their rows, and one
named like a result column (``shard``, ``slot``) is kept as ``shard_input``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.text import set_aside, stored

SHARDS = 24
# Key ranges per shard: the unit of sorting, so that no task sorts a whole shard.
RANGES = 8
# Bytes a splitter may be off, as a share of a range.
TOLERANCE = 0.01
KEY_BITS = 63
FIRST_BITS, MORE_BITS = 12, 8
ROW_BYTES = 8


@dataclass(frozen=True)
class Splitter:
    """The first (key, number) right of a cut, and what lies left of it: rows exactly, bytes too unless it cuts a key."""

    key: int
    bytes_below: int
    rows_below: int
    number: int = 0


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def sort_key(id_col: Column, text: Column) -> Column:
    checksum = F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long")
    return F.shiftleft(checksum, 31).bitwiseOR(F.xxhash64(id_col).bitwiseAND(F.lit((1 << 31) - 1)))


def splitters(keys: DataFrame, parts: int, tolerance: float = TOLERANCE) -> list[Splitter]:
    """The ``parts - 1`` cuts of (key, size) rows into parts of equal size, fewer if the table is empty.

    What reaches the driver is one row per probed bin: at most 2**FIRST_BITS,
    then at most ``parts`` times 2**MORE_BITS, whatever the input.
    """
    shift = KEY_BITS - FIRST_BITS
    bins = keys.groupBy(F.shiftright("key", shift).alias("bin")).agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    total = sum(row.b for row in bins)
    allowed = tolerance * total / parts
    wanted = {j: total * j / parts for j in range(1, parts)} if total else {}
    chosen: dict[int, Splitter] = {}
    before = {None: (0, 0)}
    while True:
        open_bins = {}
        by_parent: dict[int | None, list] = {}
        for row in bins:
            by_parent.setdefault(row["parent"] if "parent" in row else None, []).append(row)
        for parent, rows in by_parent.items():
            low, count = before[parent]
            for row in sorted(rows, key=lambda r: r.bin):
                left, right = Splitter(row.bin << shift, low, count), Splitter((row.bin + 1) << shift, low + row.b, count + row.n)
                for j, goal in wanted.items():
                    if low <= goal <= low + row.b and (j not in chosen):
                        near = min(left, right, key=lambda s: abs(s.bytes_below - goal))
                        if abs(near.bytes_below - goal) <= allowed:
                            chosen[j] = near
                        elif shift == 0:
                            # One key alone is larger than the tolerance: its rows, which are alike, are cut by number.
                            cut = round((goal - low) * row.n / row.b)
                            chosen[j] = right if cut == row.n else Splitter(row.bin, low + row.b * cut // row.n, count + cut, cut)
                        else:
                            open_bins[row.bin] = (low, count)
                low, count = low + row.b, count + row.n
        if not open_bins:
            return [chosen[j] for j in sorted(chosen)]
        last, shift = shift, max(0, shift - MORE_BITS)
        parent = F.shiftright("key", last)
        before = open_bins
        bins = (
            keys.filter(parent.isin(list(open_bins)))
            .groupBy(parent.alias("parent"), F.shiftright("key", shift).alias("bin"))
            .agg(F.sum("size").alias("b"), F.count("*").alias("n"))
            .collect()
        )


def _numbered(rows: DataFrame, heavy: list[int]) -> DataFrame:
    """The rows with ``number``: 0, 1, ... within each heavy key, 0 elsewhere.

    Rows of heavy keys are stored with a mark that fixes their order; their
    numbers are their places in their partition after all of earlier ones.
    """
    if not heavy:
        return rows.withColumn("number", F.lit(0).cast("long"))
    is_heavy = F.col("key").isin(heavy)
    marked = stored(rows.filter(is_heavy).withColumn("mark", F.monotonically_increasing_id()), "heavy-keys").withColumn("split", F.shiftright("mark", 33))
    earlier = Window.partitionBy("key").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    counts = marked.groupBy("key", "split").agg(F.count("*").alias("n"))
    before = counts.select("key", "split", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("key", "split").orderBy("mark")) - 1
    numbered = marked.withColumn("place", place).join(before, ["key", "split"])
    return rows.filter(~is_heavy).withColumn("number", F.lit(0).cast("long")).unionByName(
        numbered.select(*rows.columns, (F.col("before") + F.col("place")).alias("number"))
    )


def placed(docs: DataFrame, shards: int = SHARDS, ranges: int = RANGES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (row, size, shard, slot): every row as a struct, with its shard and its place there."""
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(id_col).alias("id"),
        size_of(F.col(text_col)).alias("size"),
        sort_key(F.col(id_col), F.col(text_col)).alias("key"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tie"),
    )
    cuts = splitters(stored(rows.select("key", "size"), "shard-keys"), shards * ranges)
    offsets = [0] * (shards * ranges)
    starts = [0] + [cut.rows_below for cut in cuts]
    for part in range(len(starts)):
        offsets[part] = starts[part] - starts[part - part % ranges]
    rows = _numbered(rows, sorted({cut.key for cut in cuts if cut.number}))
    places = F.array(*[F.struct(F.lit(cut.key).cast("long").alias("key"), F.lit(cut.number).cast("long").alias("number")) for cut in cuts])
    left_of = lambda cut: (cut["key"] < F.col("key")) | ((cut["key"] == F.col("key")) & (cut["number"] <= F.col("number")))
    part = F.size(F.filter(places, left_of)) if cuts else F.lit(0)
    ordered = Window.partitionBy("part").orderBy("key", "number", "id", "tie")
    return rows.withColumn("part", part).select(
        "row",
        "size",
        F.floor(F.col("part") / ranges).cast("int").alias("shard"),
        (F.get(F.lit(offsets).cast("array<bigint>"), F.col("part")) + F.row_number().over(ordered) - 1).alias("slot"),
    )


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The documents with ``shard`` and ``slot`` after their own columns; of those, one with such a name gets ``_input`` after it."""
    return placed(set_aside(docs, "shard", "slot"), shards).select("row.*", "shard", "slot")
