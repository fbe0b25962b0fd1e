"""CSV records of which quoted fields may hold line breaks, cut out of files that are read in splits.

Whether a line begins inside a quoted field depends on all lines before it, but
only through one bit. What a line does to that bit is one of four things: keep
it, flip it, set it or clear it. So every split is summed up on its own, the
sums of a file's splits are chained, and each split then knows how it begins.
Splits without a break in a field (most, as a rule) are read as plain lines.
In the others a window per split finds where records begin, and only the lines
of records that do have breaks are brought together.
"""

from __future__ import annotations

import csv
from collections import Counter

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F

from spendlake.functions import scalars as S
from spendlake.operators.joins import BROADCAST_ROWS
from spendlake.session import scratch_path

# A quoted field from its opening quote, at the start or after a comma, to the next comma after the closing one.
_QUOTED = r'(?:^|(?<=,))"[^"]*"[^,]*'
_SPLIT = ["file", "block"]
_SPLITS = """file string, unclosed boolean, head struct<block:bigint,pos:bigint>, block bigint, state boolean, origin bigint,
    `end` boolean, plain boolean, first struct<pos:bigint,line:string,shut:boolean>"""


def unquoted(text: Column) -> Column:
    """The text without its quoted fields; what is left has commas between fields only."""
    bare = F.regexp_replace(F.replace(text, F.lit('""'), F.lit("")), _QUOTED, "")
    return F.when(F.instr(text, '"') > 0, bare).otherwise(text)


def _ends_open(text: Column) -> Column:
    return (F.instr(text, '"') > 0) & unquoted(text).rlike('(?:^|,)"')


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All lines with their place, and whether the line ends inside a field if it begins outside (``shut``) or inside (``open``) of one."""
    line, quotes = F.col("line"), F.instr("line", '"') > 0
    return (
        # Breaks inside of fields stay as they are, so only the line feed cuts.
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos"),
            F.col("value").alias("line"),
        )
        .withColumn("shut", F.when(quotes, _ends_open(line)).otherwise(False))
        .withColumn("open", F.when(quotes, _ends_open(F.concat(F.lit('"'), line))).otherwise(True))
    )


def _through(begins_open: bool) -> Column:
    """How a split ends that begins so: whether open, and whether any line of it ended closed."""
    start = F.struct((F.lit(begins_open) & F.col("cleared").isNull()).alias("state"), F.col("cleared").isNotNull().alias("closed"))

    def after(held: Column, line: Column) -> Column:
        state = F.when(held["state"], line["open"]).otherwise(line["shut"])
        return F.struct(state.alias("state"), (held["closed"] | ~state).alias("closed"))

    return F.aggregate("turns", start, after)


def _splits(lines: DataFrame) -> DataFrame:
    """One row per split: how it begins, how it ends, whether all its lines are records, and where an open record came from.

    The lists are of one split's lines that open or flip, and of one file's splits.
    """
    clears = ~F.col("shut") & ~F.col("open")
    turns = F.col("shut")
    own = lines.groupBy(*_SPLIT).agg(
        F.max(F.when(clears, F.col("pos"))).alias("cleared"),
        F.array_sort(F.collect_list(F.when(turns, F.struct("pos", "shut", "open")))).alias("turns"),
        F.min(F.when(F.trim("line") != "", F.struct("pos", "line", "shut"))).alias("first"),
    )
    own = own.withColumn("plain", F.size("turns") == 0)
    own = own.withColumn("turns", F.filter("turns", lambda t: F.col("cleared").isNull() | (t["pos"] > F.col("cleared"))))
    own = own.select(*_SPLIT, "plain", "first", _through(False).alias("from_shut"), _through(True).alias("from_open"))
    start = F.struct(
        F.lit(False).alias("state"),
        F.lit(0).cast("long").alias("origin"),
        F.expr("cast(array() as array<struct<block:bigint,state:boolean,origin:bigint,end:boolean,plain:boolean,first:struct<pos:bigint,line:string,shut:boolean>>>)").alias("out"),
    )

    def chained(held: Column, split: Column) -> Column:
        end = F.when(held["state"], split["from_open"]).otherwise(split["from_shut"])
        row = F.struct(
            split["block"].alias("block"),
            held["state"].alias("state"),
            held["origin"].alias("origin"),
            end["state"].alias("end"),
            (split["plain"] & ~held["state"]).alias("plain"),
            split["first"].alias("first"),
        )
        begun_here = ~held["state"] | end["closed"]
        return F.struct(
            end["state"].alias("state"),
            F.when(begun_here, split["block"]).otherwise(held["origin"]).alias("origin"),
            F.concat(held["out"], F.array(row)).alias("out"),
        )

    ordered = F.array_sort(F.collect_list(F.struct("block", "plain", "first", "from_shut", "from_open")))
    files = own.groupBy("file").agg(ordered.alias("splits"))
    chain = F.aggregate("splits", start, chained, lambda held: F.struct(held["state"].alias("unclosed"), held["out"].alias("out")))
    head = F.element_at(F.filter("_chain.out", lambda s: s["first"].isNotNull()), 1)
    return (
        files.withColumn("_chain", chain)
        .select("file", F.col("_chain.unclosed").alias("unclosed"), F.struct(head["block"].alias("block"), head["first"]["pos"].alias("pos")).alias("head"), F.inline("_chain.out"))
        .drop("from_shut", "from_open")
    )


def _cut(lines: DataFrame) -> DataFrame:
    """Records of splits with breaks in fields, from lines that know how their split begins and ends."""
    flips, sets = F.col("shut") & ~F.col("open"), F.col("shut") == F.col("open")
    split = Window.partitionBy(*_SPLIT)
    before = split.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    upto = split.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    counted = lines.withColumn("_flips", F.coalesce(F.sum(flips.cast("int")).over(before), F.lit(0)))
    fixed = F.last(F.when(sets, F.struct(F.col("shut").alias("to"), F.col("_flips").alias("at"))), True).over(before)
    counted = counted.withColumn("_fixed", fixed)
    inside = F.coalesce(F.col("_fixed.to"), F.col("state")) != ((F.col("_flips") - F.coalesce(F.col("_fixed.at"), F.lit(0))) % 2 == 1)
    placed = counted.withColumn("_begins", ~inside)
    placed = placed.withColumns(
        {
            "_record": F.last(F.when(F.col("_begins"), F.col("pos")), True).over(upto),
            "_next": F.lead("_begins").over(split.orderBy("pos")),
            "_latest": F.max(F.when(F.col("_begins"), F.col("pos"))).over(split),
        }
    )
    alone = F.col("_begins") & F.coalesce(F.col("_next"), ~F.col("end"))
    singles = placed.where(alone).select(*_SPLIT, "pos", F.col("line").alias("record"), "head")
    # A record that goes on in the next split is named after the split it begins in, any other after its first line.
    goes_on = F.col("end") & (F.col("_record") == F.col("_latest"))
    key = (
        F.when(F.col("_record").isNull(), F.struct(F.col("origin").alias("block"), F.lit(-1).cast("long").alias("pos")))
        .when(goes_on, F.struct(F.col("block"), F.lit(-1).cast("long").alias("pos")))
        .otherwise(F.struct(F.col("block"), F.col("_record").alias("pos")))
    )
    parts = placed.where(~alone).groupBy("file", key.alias("_key"))
    joined = parts.agg(
        F.array_sort(F.collect_list(F.struct("block", "pos", "line"))).alias("_lines"),
        F.first("head").alias("head"),
    )
    text = F.array_join(F.transform("_lines", lambda part: part["line"]), "\n")
    first = F.get("_lines", F.lit(0))
    several = joined.select("file", first["block"].alias("block"), first["pos"].alias("pos"), text.alias("record"), "head")
    return singles.unionByName(several)


def csv_records(spark: SparkSession, path: str | list[str]) -> tuple[str | None, DataFrame]:
    """The first file's header line, and all records: file, block, pos (their place), and the record, or ``header`` for the first of a file.

    A blank line outside of fields is no record. A file whose last quoted field
    is never closed is an error that names it, and so is a header over several lines.
    """
    lines = _lines(spark, path)
    where = scratch_path(spark, "splits")
    top = F.struct("file", F.col("first.line").alias("line"), F.col("first.shut").alias("shut"))
    # What the driver must know of the splits is gathered while they are written.
    seen = Observation()
    _splits(lines).observe(
        seen,
        F.min(F.when(F.col("block") == F.col("head.block"), top)).alias("top"),
        F.min(F.when(F.col("unclosed"), F.col("file"))).alias("unclosed"),
        F.every("plain").alias("plain"),
        F.count(F.lit(1)).alias("splits"),
    ).write.parquet(where)
    splits = spark.read.schema(_SPLITS).parquet(where)
    told = Row(**seen.get)
    if told.unclosed:
        raise ValueError(f"a quoted field is not closed in {told.unclosed}")
    if told.top and told.top.shut:
        raise ValueError(f"the header goes over several lines in {told.top.file}")
    known = splits.drop("first", "unclosed")
    known = F.broadcast(known) if told.splits <= BROADCAST_ROWS else known
    placed = lines.join(known, _SPLIT)
    # As a condition: a check or cast of records that is moved down meets a null where a line is no record.
    whole = F.when(F.col("plain"), F.col("line"))
    records = placed.where("plain").select(*_SPLIT, "pos", whole.alias("record"), "head")
    if told.plain is False:
        records = records.unionByName(_cut(placed.where("NOT plain")))
    text = F.regexp_replace("record", "\r$", "")
    is_head = (F.col("block") == F.col("head.block")) & (F.col("pos") == F.col("head.pos"))
    header = told.top.line.removesuffix("\r") if told.top else None
    records = records.where(F.trim("record") != "").select("file", "block", "pos", F.when(~is_head, text).alias("record"), F.when(is_head, text).alias("header"))
    return header, records


def header_names(header: str) -> list[str]:
    """The names in a header line: one that is empty is named after its place, and one that occurs again gets it added."""
    names = next(csv.reader([header]))
    held = Counter(name.lower() for name in names)
    return [f"_c{n}" if not name else f"{name}{n}" if held[name.lower()] > 1 else name for n, name in enumerate(names)]


def fields_in(record: Column) -> Column:
    """How many fields a record has."""
    return F.size(F.split(unquoted(record), ","))


def parsed(record: Column, names: list[str]) -> Column:
    """The fields as a struct; missing ones null, surplus ones left out."""
    kind = ", ".join(f"{S.quoted(name)} string" for name in names)
    return F.from_csv(record, kind, {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"})
