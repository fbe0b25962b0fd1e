"""A corpus from documents to shards: every stage keeps rows whole and hands on what it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.llm.decontaminate import drop_contaminated
from spendlake.llm.language_id import keep_identified
from spendlake.llm.mixing import mixed
from spendlake.llm.near_dedup import drop_near_duplicates
from spendlake.llm.queries import MIX_LEVELS, MIX_WEIGHTS, fold
from spendlake.llm.sharding import sharded
from spendlake.llm.text import stored, table

# Language ID and the hashes of the other stages have no counterpart in SQL.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    return keep_identified(docs, fold(F.col("doc_id")) != 0)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word shingles alike to 80 percent."""
    return drop_near_duplicates(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is in the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every leaf of the source tree cut or repeated to its token budget."""
    return mixed(docs, MIX_LEVELS, MIX_WEIGHTS)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their slot in it."""
    return sharded(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
