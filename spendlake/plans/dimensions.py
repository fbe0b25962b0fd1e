"""Dimension seeds: ids in seed order, parents found by name, re-seeding adds nothing twice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake import fixed_values as V
from spendlake import schemas
from spendlake.functions.scalars import display_name, named
from spendlake.operators.combine import first_by_key
from spendlake.operators.joins import Dimensions, first_match
from spendlake.operators.ordering import with_position
from spendlake.sources.literals import literal_relation
from spendlake.sources.tables import insert_if_absent, upsert

FIRST_ID = 100


def find_parent(rows: DataFrame, parent: DataFrame, name: str, out: str, how: str = "inner") -> DataFrame:
    """Replace the column ``name`` by the id of the parent with that name."""
    known = first_match(parent, ["name"]).select(F.col("name").alias(name), F.col("id").alias(out))
    return rows.join(known, name, how).drop(name)


def add_members(existing: DataFrame | None, rows: DataFrame, keys: Sequence[str], order: str = "ord") -> DataFrame:
    """Number the rows an existing dimension lacks, after its highest id, and add them.

    Equal new keys are rows of their own unless the dimension already has them;
    names that are unique by definition are made so by the caller.
    """
    if existing is None:
        ids = with_position(rows, order, start=FIRST_ID, out="id")
        return ids.withColumn("id", F.col("id").cast("int")).drop(order)
    held = existing.select(*keys).distinct()
    same = F.lit(True)
    for key in keys:
        same = same & rows[key].eqNullSafe(held[key])
    missing = rows.join(held, same, "left_anti")
    last = existing.agg(F.coalesce(F.max("id"), F.lit(FIRST_ID - 1))).scalar()
    placed = with_position(missing, order, start=1, out="id")
    numbered = placed.withColumn("id", (F.col("id") + last).cast("int")).drop(order)
    return existing.unionByName(numbered.select(*[named(name) for name in existing.columns]))


def seed_states(spark: SparkSession) -> DataFrame:
    return literal_relation(spark, list(V.STATE_NAMES.items()), schemas.STATES)


def _seed_rows(spark: SparkSession, rows: Sequence[tuple], **columns: T.DataType) -> DataFrame:
    schema = T.StructType([T.StructField("ord", T.IntegerType())])
    for name, kind in columns.items():
        schema = schema.add(name, kind)
    return literal_relation(spark, [(place, *row) for place, row in enumerate(rows)], schema)


def seed_titles(
    spark: SparkSession, descriptions: Mapping[str, str] | None = None, existing: DataFrame | None = None
) -> DataFrame:
    texts = V.TITLE_DESCRIPTIONS if descriptions is None else descriptions
    rows = [(name, texts.get(name)) for name in V.TITLES]
    seeds = _seed_rows(spark, rows, name=T.StringType(), description=T.StringType())
    return add_members(existing, first_by_key(seeds, ["name"], ["ord"]), ["name"]).select(*schemas.TITLES.names)


def seed_subtitles(
    spark: SparkSession, titles: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    seeds = _seed_rows(spark, V.SUBTITLES, name=T.StringType(), title=T.StringType())
    rows = find_parent(seeds, titles, "title", "title_id")
    return add_members(existing, rows, ["name", "title_id"]).select(*schemas.SUBTITLES.names)


def seed_programs(
    spark: SparkSession, titles: DataFrame, subtitles: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    seeds = _seed_rows(spark, V.PROGRAMS, name=T.StringType(), title=T.StringType(), subtitle=T.StringType())
    placed = find_parent(seeds, titles, "title", "title_id")
    rows = find_parent(placed, subtitles, "subtitle", "subtitle_id", "left")
    return add_members(existing, rows, ["name", "title_id"]).select(*schemas.PROGRAMS.names)


def seed_sub_programs(
    spark: SparkSession, programs: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    seeds = _seed_rows(spark, V.SUB_PROGRAMS, name=T.StringType(), program=T.StringType())
    rows = find_parent(seeds, programs, "program", "program_id")
    return add_members(existing, rows, ["name", "program_id"]).select(*schemas.SUB_PROGRAMS.names)


def seed_sub_sub_programs(
    spark: SparkSession, sub_programs: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    seeds = _seed_rows(spark, V.SUB_SUB_PROGRAMS, name=T.StringType(), sub_program=T.StringType())
    rows = find_parent(seeds, sub_programs, "sub_program", "sub_program_id")
    return add_members(existing, rows, ["name", "sub_program_id"]).select(*schemas.SUB_SUB_PROGRAMS.names)


def seed_practice_categories(
    spark: SparkSession, programs: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    seeds = _seed_rows(
        spark,
        V.PRACTICE_CATEGORIES,
        name=T.StringType(),
        display_name=T.StringType(),
        category_grouping=T.StringType(),
        program=T.StringType(),
        is_statutory_category=T.BooleanType(),
    )
    rows = find_parent(seeds, programs, "program", "program_id")
    members = add_members(existing, rows, ["name", "program_id"])
    return members.select(*schemas.PRACTICE_CATEGORIES.names)


def seed_practices(merged: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Practices out of the merged list (code, name, source); a known code takes the new texts.

    Of several lines of one code the last one in the file wins, if the list was
    read with its order in the column ``ord``; else the greatest name.
    """
    rows = merged.select(
        F.col("practice_code").alias("code"),
        F.col("practice_name").alias("name"),
        display_name(F.col("practice_name"), F.col("practice_code")).alias("display_name"),
        "source",
        *[name for name in ("ord",) if name in merged.columns],
    )
    if existing is None:
        existing = rows.limit(0).select(*schemas.PRACTICES.names)
    order = "ord" if "ord" in rows.columns else "name"
    return upsert(existing, rows, ["code"], [order]).select(*schemas.PRACTICES.names)


def seed_dimensions(
    spark: SparkSession,
    merged_practices: DataFrame,
    descriptions: Mapping[str, str] | None = None,
    existing: Dimensions | None = None,
) -> Dimensions:
    """All dimensions; with ``existing`` ones, what they lack is added."""

    def held(name: str) -> DataFrame | None:
        return getattr(existing, name) if existing else None

    states = seed_states(spark)
    if existing:
        states = insert_if_absent(existing.states, states, ["code"], ["name"])
    titles = seed_titles(spark, descriptions, held("titles"))
    subtitles = seed_subtitles(spark, titles, held("subtitles"))
    programs = seed_programs(spark, titles, subtitles, held("programs"))
    sub_programs = seed_sub_programs(spark, programs, held("sub_programs"))
    return Dimensions(
        states=states,
        titles=titles,
        subtitles=subtitles,
        programs=programs,
        sub_programs=sub_programs,
        sub_sub_programs=seed_sub_sub_programs(spark, sub_programs, held("sub_sub_programs")),
        practice_categories=seed_practice_categories(spark, programs, held("practice_categories")),
        practices=seed_practices(merged_practices, held("practices")),
    )


def _version(spark: SparkSession, path: str) -> int:
    """The newest complete version below a path, 0 if there is none."""
    versions = f"{path.rstrip('/')}/versions"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(versions)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return 0
    return spark.read.schema("version int").parquet(versions).agg(F.max("version")).first()[0] or 0


def store_dimensions(dims: Dimensions, path: str) -> Dimensions:
    """Write every dimension as a table and read it back: loads then start from files, not from seeds.

    Each call writes a new version and names it only when all its tables are
    there, so dimensions may be stored where they are read from, and a call that
    fails leaves the former version in force.
    """
    spark = dims.titles.sparkSession
    number = _version(spark, path) + 1
    for name in Dimensions.__dataclass_fields__:
        getattr(dims, name).write.mode("overwrite").parquet(f"{path.rstrip('/')}/v{number}/{name}")
    done = spark.createDataFrame([(number,)], "version int").coalesce(1)
    done.write.mode("append").parquet(f"{path.rstrip('/')}/versions")
    return open_dimensions(spark, path)


def open_dimensions(spark: SparkSession, path: str) -> Dimensions:
    base = f"{path.rstrip('/')}/v{_version(spark, path)}"
    return Dimensions(**{name: spark.read.parquet(f"{base}/{name}") for name in Dimensions.__dataclass_fields__})
