"""Look-ups against dimensions, measure joins and rejects."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.functions import scalars as S
from spendlake.operators.combine import first_by_key, union_all, union_missing

# Dimension rows are a few short columns, so this many stay far below 100 MB.
BROADCAST_ROWS = 200_000

ENTITY_IDS = ["title_id", "subtitle_id", "program_id", "sub_program_id", "sub_sub_program_id"]


@dataclass(frozen=True)
class Dimensions:
    """The tables around the facts."""

    states: DataFrame
    titles: DataFrame
    subtitles: DataFrame
    programs: DataFrame
    sub_programs: DataFrame
    sub_sub_programs: DataFrame
    practice_categories: DataFrame
    practices: DataFrame


def _few(frames: Sequence[DataFrame], limit: int) -> bool:
    return union_all(*[frame.select(F.lit(1).alias("row")) for frame in frames]).count() <= limit


def small_side(df: DataFrame, *bounds: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if a count shows ``df`` is small.

    ``bounds`` are frames that together have at least as many rows and are
    cheaper to count. Above the limit the join shuffles, and splits hot
    partitions of the other side at run time. Only for sides whose size the
    planner cannot know beforehand, such as joins of dimensions; plain tables it
    measures and broadcasts by itself.
    """
    return F.broadcast(df) if _few(bounds or (df,), limit) else df


def keyed_side(df: DataFrame, *bounds: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The same for a side with one row per join key; above the limit its partitions become hash tables.

    The other side is read past them without a sort, so a key that many of its
    rows share, such as a name that is unknown, takes no memory.
    """
    return F.broadcast(df) if _few(bounds or (df,), limit) else df.hint("shuffle_hash")


def combine_measures(base: DataFrame, *others: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Left-join measure frames that share the keys; one shuffle of each frame serves all joins."""
    keys = list(keys or ["state_code", "year", "entity_name", "entity_type"])
    for other in others:
        base = base.join(other, keys, "left")
    return base


def first_match(dimension: DataFrame, keys: Sequence[str], order: Sequence[str] = ("id",)) -> DataFrame:
    """One row per key, the one with the smallest id."""
    return first_by_key(dimension, keys, order)


def subtitle_entities(dims: Dimensions) -> DataFrame:
    found = dims.subtitles.select(
        F.col("name").alias("entity_name"), "title_id", F.col("id").alias("subtitle_id")
    )
    return first_match(found, ["entity_name"], ["subtitle_id"])


def program_entities(dims: Dimensions) -> DataFrame:
    found = dims.programs.select(
        F.col("name").alias("entity_name"), "title_id", "subtitle_id", F.col("id").alias("program_id")
    )
    return first_match(found, ["entity_name"], ["program_id"])


def _programs(dims: Dimensions) -> DataFrame:
    return dims.programs.select(F.col("id").alias("program_id"), "title_id", "subtitle_id")


def sub_program_entities(dims: Dimensions) -> DataFrame:
    children = dims.sub_programs.select(
        F.col("name").alias("entity_name"), "program_id", F.col("id").alias("sub_program_id")
    )
    found = children.join(_programs(dims), "program_id").select(
        "entity_name", "title_id", "subtitle_id", "program_id", "sub_program_id"
    )
    return first_match(found, ["entity_name"], ["sub_program_id", "program_id"])


def sub_sub_program_entities(dims: Dimensions) -> DataFrame:
    children = dims.sub_sub_programs.select(
        F.col("name").alias("entity_name"), "sub_program_id", F.col("id").alias("sub_sub_program_id")
    )
    parents = dims.sub_programs.select(F.col("id").alias("sub_program_id"), "program_id")
    found = (
        children.join(parents, "sub_program_id")
        .join(_programs(dims), "program_id")
        .select("entity_name", *ENTITY_IDS)
    )
    return first_match(found, ["entity_name"], ["sub_sub_program_id", "sub_program_id", "program_id"])


def entity_dimension(dims: Dimensions) -> DataFrame:
    """Every nameable entity with its type and the ids of its whole path."""
    levels = {
        "subtitle": subtitle_entities(dims),
        "program": program_entities(dims),
        "sub_program": sub_program_entities(dims),
        "sub_sub_program": sub_sub_program_entities(dims),
    }
    stacked = union_missing(*[frame.withColumn("entity_type", F.lit(kind)) for kind, frame in levels.items()])
    return stacked.select("entity_type", "entity_name", *ENTITY_IDS)


def small_entity_dimension(dims: Dimensions) -> DataFrame:
    """The same, to be broadcast if small: it has at most one row per row of the four tables."""
    return keyed_side(
        entity_dimension(dims), dims.subtitles, dims.programs, dims.sub_programs, dims.sub_sub_programs
    )


def resolve_subtitle(df: DataFrame, dims: Dimensions) -> DataFrame:
    return df.join(subtitle_entities(dims), "entity_name")


def resolve_program(df: DataFrame, dims: Dimensions) -> DataFrame:
    return df.join(program_entities(dims), "entity_name")


def resolve_sub_program(df: DataFrame, dims: Dimensions) -> DataFrame:
    return df.join(keyed_side(sub_program_entities(dims), dims.sub_programs), "entity_name")


def resolve_sub_sub_program(df: DataFrame, dims: Dimensions) -> DataFrame:
    return df.join(keyed_side(sub_sub_program_entities(dims), dims.sub_sub_programs), "entity_name")


def resolve_entities(df: DataFrame, dims: Dimensions, how: str = "inner") -> DataFrame:
    """Resolve rows of every entity type in one join on (type, name)."""
    return df.join(small_entity_dimension(dims), ["entity_type", "entity_name"], how)


def resolve_category(df: DataFrame, categories: DataFrame) -> DataFrame:
    """Optional look-up of a practice category within its program; no match leaves null."""
    found = first_match(
        categories.select(
            F.col("name").alias("practice_category"), "program_id", F.col("id").alias("practice_category_id")
        ),
        ["practice_category", "program_id"],
        ["practice_category_id"],
    )
    return df.join(found, ["practice_category", "program_id"], "left")


def rejects(df: DataFrame, dimension: DataFrame, keys: Sequence[str], reason: str) -> DataFrame:
    """Rows without a partner in ``dimension``, with the reason; a null key has none."""
    keys = list(keys)
    known = dimension.select(*[S.named(key) for key in keys])
    return df.join(known, keys, "left_anti").withColumn("reason", F.lit(reason))


def with_name(facts: DataFrame, dimension: DataFrame, key: str, out: str) -> DataFrame:
    """Facts with the name of one dimension; facts without a match drop out."""
    names = dimension.select(F.col("id").alias(key), F.col("name").alias(out))
    return facts.join(names, key)


def match_contains(df: DataFrame, reference: DataFrame, code: str, ref_code: str, ref_order: str) -> DataFrame:
    """For each row the first reference code, in list order, that occurs inside its code.

    Of a reference code the first or the last letters are its seed, whichever
    fewer others share, as many as the greatest power of two that fits: at least
    half of it. Substrings of these few lengths are joined with the seeds on
    equality, and a code that holds a seed is searched for the whole reference.
    So the cost does not depend on how many lengths the list has. This runs once
    per distinct code; rows get the answer back by their code, or null.
    """
    listed = reference.groupBy(S.named(ref_code).alias("_ref")).agg(F.min(S.named(ref_order)).alias("_order")).where("_ref IS NOT NULL")
    long = F.length("_ref")
    width = F.when(long > 0, F.pow(F.lit(2), F.floor(F.log2(long)))).otherwise(0).cast("int")
    ends = F.array(F.substr(F.col("_ref"), F.lit(1), width), F.substr(F.col("_ref"), long - width + 1, width))
    seeds = listed.select("_ref", "_order", width.alias("_width"), F.explode(F.array_distinct(ends)).alias("_seed"))
    shared = seeds.groupBy("_seed").agg(F.count(F.lit(1)).alias("_refs"))
    seeds = seeds.join(shared, "_seed").groupBy("_ref", "_order", "_width").agg(F.min_by("_seed", F.struct("_refs", "_seed")).alias("_seed"))
    widths = listed.agg(F.collect_set(width).alias("widths"))
    codes = df.select(S.named(code).alias("_code")).where("_code IS NOT NULL").distinct()
    size = F.length("_code")
    fitting = F.filter(F.col("_widths"), lambda width: width <= size)
    pieces = F.flatten(
        F.transform(
            fitting,
            lambda width: F.transform(
                F.sequence(F.lit(1), size - width + 1),
                lambda at: F.substr(F.col("_code"), at, width),
            ),
        )
    )
    grams = codes.withColumn("_widths", widths.scalar()).select("_code", F.explode(F.array_distinct(pieces)).alias("_seed"))
    best = (
        grams.join(seeds, "_seed")
        .where(F.contains("_code", "_ref"))
        .groupBy("_code")
        .agg(F.min(F.struct("_order", "_ref")).alias("_best"))
        .select("_code", F.col("_best._ref").alias("matched_code"))
    )
    return df.join(best, S.named(code) == F.col("_code"), "left").drop("_code")
