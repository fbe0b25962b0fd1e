"""Words, word n-grams and row keys shared by the operators."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.session import scratch_path

SPACES = r"\x20\x09-\x0D"
PUNCTUATION = r"\x00-\x2F\x3A-\x60\x7B-\x7F"

# Keys of a row inside an operator: the id and a hash of the text, so that rows
# which share an id but not a text are kept apart and null ids are no exception.
KEY = ["k_id", "k_text"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else; ``lower`` does the same on plain ASCII and is faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words(text: Column, separators: str = SPACES) -> Column:
    """The maximal runs of characters outside ``separators``; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{separators}]+"), "")


def gram_hashes(tokens: Column, size: int) -> Column:
    """A 64-bit hash of every ``size`` consecutive words, by position; empty for fewer words."""
    hashed = F.transform(tokens, lambda word: F.xxhash64(word))
    return let(
        hashed,
        lambda h: F.when(
            F.size(h) >= size,
            F.transform(F.sequence(F.lit(1), F.size(h) - size + 1), lambda i: F.xxhash64(F.slice(h, i, size))),
        ).otherwise(F.slice(h, 1, 0)),
    )


def keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Only the row key, the text with null as empty, and ``more``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("k_id"), F.xxhash64(text).alias("k_text"), text.alias("text"), *more)


def set_aside(docs: DataFrame, *results: str) -> DataFrame:
    """The same rows, with ``_input`` after the name of every column that is named like a result, in either case."""
    taken = {name.lower() for name in docs.columns}
    names = []
    for name in docs.columns:
        while name.lower() in results or (name not in docs.columns and name.lower() in taken):
            name += "_input"
        taken.add(name.lower())
        names.append(name)
    return docs.toDF(*names)


def same_key(left: DataFrame, right: DataFrame) -> Column:
    return left["k_id"].eqNullSafe(right["k_id"]) & (left["k_text"] == right["k_text"])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: computed once, and no lineage behind it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
