"""URL filters as a temporal join with dated lists.

Entries (list, pattern, day, action) become validity intervals: an addition
holds from its day up to the next entry of the same list and pattern. A capture
is asked for its host and all parent domains, as of its fetch day. Intervals
and captures are cut by month, so the join is on (pattern, month) and one busy
host is spread over its months; within those, adaptive execution splits it.

Defined results: of several entries of one list, pattern and day a removal
wins, and repeats change nothing; an entry without list, pattern, day or a known
action is left out; a capture without URL, host or day is not blocked; patterns
and hosts are compared in lower case without a closing dot; captures that
repeat id and URL get a row each; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#]*@)?([^/?#:]*)"
ADD, REMOVE = "add", "remove"


def host_of(url: Column) -> Column:
    return F.rtrim(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1)), F.lit("."))


def domains(host: Column) -> Column:
    """The host and its parents down to two labels; a host of one label is its own."""
    labels = F.split(host, r"\.")
    starts = F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, since, until): when an entry is active, ``until`` excluded and null if open."""
    known = entries.filter(F.col("action").isin(ADD, REMOVE)).select(
        "list", F.rtrim(F.lower("pattern"), F.lit(".")).alias("pattern"), F.col("day").cast("date").alias("day"), "action"
    )
    # One row per day and pattern, made before anything is moved, bounds the window.
    daily = known.dropna().groupBy("list", "pattern", "day").agg(F.max("action").alias("action"))
    following = F.lead("day").over(Window.partitionBy("list", "pattern").orderBy("day"))
    return daily.withColumn("until", following).filter(F.col("action") == ADD).select("list", "pattern", F.col("day").alias("since"), "until")


def active_lists(captures: DataFrame, entries: DataFrame, id_col: str, url_col: str, day_col: str) -> DataFrame:
    """Per capture: id, url, day and ``lists``, the sorted lists that hold its host on that day."""
    asked = captures.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(day_col).cast("date").alias("day"))
    wanted = asked.select("url", "day", F.explode(domains(host_of(F.col("url")))).alias("pattern"), F.trunc("day", "month").alias("month"))
    wanted = wanted.filter("pattern <> '' AND day IS NOT NULL").distinct()
    # Only the months in which something was fetched are laid out.
    begin, end = (F.lit(day).cast("date") for day in asked.agg(F.min("day"), F.max("day")).first())
    spans = intervals(entries).filter((F.col("since") <= end) & (F.col("until").isNull() | (F.col("until") > begin)))
    months = F.sequence(
        F.trunc(F.greatest("since", begin), "month"), F.trunc(F.least("until", end), "month"), F.expr("INTERVAL 1 MONTH")
    )
    monthly = spans.select("list", "pattern", "since", "until", F.explode(months).alias("month"))
    met = wanted.join(monthly, ["pattern", "month"]).filter("day >= since AND (until IS NULL OR day < until)")
    lists = met.groupBy("url", "day").agg(F.array_sort(F.collect_set("list")).alias("lists"))
    return asked.join(lists, ["url", "day"], "left").select("id", "url", "day", F.coalesce("lists", F.expr("CAST(array() AS array<string>)")).alias("lists"))


def drop_listed(captures: DataFrame, entries: DataFrame, url_col: str, day_col: str) -> DataFrame:
    """Captures that no list held when they were fetched, with all their columns."""
    row = captures.select(F.struct("*").alias("row"), F.col(url_col).alias("url"), F.col(day_col).cast("date").alias("day"))
    bad = active_lists(captures, entries, url_col, url_col, day_col).filter(F.size("lists") > 0).select("url", "day").distinct()
    return row.join(bad, ["url", "day"], "left_anti").select("row.*")
