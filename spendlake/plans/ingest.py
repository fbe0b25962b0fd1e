"""The whole load: source files to a fact table, one partition and one bulk write per source."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake import fixed_values as V
from spendlake.operators.columns import to_numeric
from spendlake.operators.combine import union_missing
from spendlake.operators.joins import ENTITY_IDS, Dimensions, entity_dimension
from spendlake.plans.commodity import arc_plc_payments, arc_plc_rejects, dairy_disaster_payments
from spendlake.plans.conservation import (
    conservation_union,
    easement_payments,
    easement_rejects,
    practice_payments,
    practice_rejects,
    reserve_payments,
    reserve_rejects,
)
from spendlake.plans.facts import accepted, broken_rules, judge_payments, rejected
from spendlake.plans.insurance import insurance_benefits, insurance_rejects
from spendlake.plans.nutrition import costs_participation, costs_participation_rejects
from spendlake.plans.reports import node_sums
from spendlake.schemas import PAYMENTS, SOURCE_NUMBER
from spendlake.session import scratch_path
from spendlake.sources import parts
from spendlake.sources.files import read_csv
from spendlake.sources.tables import open_sources, stage_source

ARC_PLC = {
    "payments": {V.ARC_CO: "arc_co_payments", V.ARC_IC: "arc_ic_payments", V.PLC: "plc_payments"},
    "base_acres": {V.ARC_CO: "arc_co_base_acres", V.PLC: "plc_base_acres"},
    "recipients": {V.ARC_CO: "arc_co_recipients", V.ARC_IC: "arc_ic_recipients", V.PLC: "plc_recipients"},
}
PRACTICE_PROGRAMS = {"eqip": V.EQIP, "csp": V.CSP}
EASEMENT_PROGRAMS = {"acep": V.ACEP, "rcpp": V.RCPP}
# Source -> the files it is made of, by the name their path is given under. A source loads as a whole.
SOURCES = {
    "arc_plc": tuple(name for group in ARC_PLC.values() for name in group.values()),
    "dairy_disaster": ("dairy_disaster",),
    **{name: (name,) for name in (*PRACTICE_PROGRAMS, "crp", *EASEMENT_PROGRAMS)},
    "snap": ("snap_costs", "snap_participation"),
    "crop_insurance": ("crop_insurance",),
}
TITLES = {
    "commodity": ("arc_plc", "dairy_disaster"),
    "conservation": ("eqip", "csp", "crp", "acep", "rcpp"),
    "nutrition": ("snap",),
    "insurance": ("crop_insurance",),
}
REJECTS = T.StructType([T.StructField(name, T.StringType()) for name in ("step", "reason", "row")])


@dataclass(frozen=True)
class Source:
    """The payments of one source, and the rows its cleaning leaves out with the reason."""

    payments: DataFrame
    left_out: DataFrame | None = None


@dataclass(frozen=True)
class Load:
    """The tables after a load, and for every constraint that is broken the number of rows."""

    facts: DataFrame
    rejects: DataFrame
    broken: dict[str, int]


def _source_numbers(df: DataFrame) -> DataFrame:
    """Numbers of payments read as text to decimals and years to integers; bad text is an error."""
    numbers = [
        field.name
        for field in PAYMENTS.fields
        if field.name in df.columns and field.dataType.typeName() in ("long", "decimal")
    ]
    amount = ["amount"] if "amount" in df.columns else []
    return to_numeric(df, [*amount, *numbers], SOURCE_NUMBER)


def given_sources(paths: Mapping[str, str]) -> list[str]:
    """The sources whose files are all given; a name that is unknown or a source in part is an error."""
    unknown = sorted(set(paths) - {name for names in SOURCES.values() for name in names})
    if unknown:
        raise ValueError(f"unknown source files: {', '.join(unknown)}")
    found = []
    for source, names in SOURCES.items():
        missing = [name for name in names if name not in paths]
        if len(missing) < len(names):
            if missing:
                raise ValueError(f"source {source} lacks the files {', '.join(missing)}")
            found.append(source)
    return found


def read_sources(
    spark: SparkSession,
    paths: Mapping[str, str],
    first: int = 2014,
    last: int = 2023,
    nutrition_last: int = 2024,
) -> dict[str, Source]:
    """Payments and cleaning rejects of every source given."""
    sources = given_sources(paths)
    read = {name: read_csv(spark, path) for name, path in paths.items()}
    found = {}
    for source in sources:
        if source == "arc_plc":
            tables = {m: {entity: read[name] for entity, name in group.items()} for m, group in ARC_PLC.items()}
            found[source] = Source(arc_plc_payments(**tables, first=first, last=last), arc_plc_rejects(*tables.values()))
        elif source == "dairy_disaster":
            found[source] = Source(dairy_disaster_payments(read[source]))
        elif source in PRACTICE_PROGRAMS:
            rows = practice_payments(read[source], PRACTICE_PROGRAMS[source], first, last)
            found[source] = Source(_source_numbers(rows), practice_rejects(read[source], first, last))
        elif source == "crp":
            rows = reserve_payments(read[source], first, last)
            found[source] = Source(_source_numbers(rows), reserve_rejects(read[source], first, last))
        elif source in EASEMENT_PROGRAMS:
            rows = easement_payments(read[source], EASEMENT_PROGRAMS[source], first, last)
            found[source] = Source(_source_numbers(rows), easement_rejects(read[source], first, last))
        elif source == "snap":
            tables = read["snap_costs"], read["snap_participation"]
            found[source] = Source(
                costs_participation(*tables, first, nutrition_last), costs_participation_rejects(*tables, first, nutrition_last)
            )
        else:
            rows = insurance_benefits(read[source], first, last)
            found[source] = Source(_source_numbers(rows), insurance_rejects(read[source], first, last))
    return found


def source_payments(spark: SparkSession, paths: Mapping[str, str], *years: int) -> dict[str, DataFrame]:
    """Payments of each title whose files are given, its sources put together."""
    found = read_sources(spark, paths, *years)
    result = {}
    for title, names in TITLES.items():
        frames = [found[name].payments for name in names if name in found]
        if frames:
            union = conservation_union if title == "conservation" else union_missing
            result[title] = union(*frames)
    return result


def _reject_rows(rows: DataFrame, step: str) -> DataFrame:
    """Rejects of any layout in one: the step, the reason and the row as it came."""
    others = [name for name in rows.columns if name != "reason"]
    return rows.select(F.lit(step).alias("step"), F.col("reason"), F.to_json(F.struct(*[F.col(f"`{n}`") for n in others])).alias("row"))


def load_source(name: str, source: Source, dims: Dimensions, entities: DataFrame, table: str, rejects_table: str) -> None:
    """Judge a source once, as a stored table, and put its facts, their sums and its rejects in place of what it held.

    All are written beside the former ones; one small write then makes them
    count together. A load that dies before leaves the tables as they were.
    """
    spark = source.payments.sparkSession
    judged_path = scratch_path(spark, f"judged-{name}")
    # By status, so that either side reads its own files only.
    judged = judge_payments(source.payments, dims, entities).withColumn("accepted", F.col("reason").isNull())
    judged.write.partitionBy("accepted").parquet(judged_path)
    rows = spark.read.schema(judged.schema).parquet(judged_path)
    load = parts.new_load()
    stage_source(accepted(rows.where("accepted").drop("accepted"), name), table, name, load)
    left_out = _reject_rows(rejected(rows.where("NOT accepted").drop("accepted")), "load")
    if source.left_out is not None:
        left_out = left_out.unionByName(_reject_rows(source.left_out, "cleaning"))
    left_out.write.mode("overwrite").parquet(parts.part_path(rejects_table, "source", name, load))
    staged = spark.read.schema(PAYMENTS).parquet(parts.part_path(table, "source", name, load))
    stage_source(node_sums(staged), _sums_path(table), name, load)
    parts.switch(spark, table, {name: load})


def _sums_path(table: str) -> str:
    return f"{table.rstrip('/')}/_sums"


def open_sums(spark: SparkSession, table: str) -> DataFrame:
    """Payments by node, state and year with their source, for reports that need no single fact."""
    ids = [field for field in PAYMENTS.fields if field.name in (*ENTITY_IDS, "state_code", "year")]
    kinds = [*ids, T.StructField("payment", T.DecimalType(24, 2)), T.StructField("source", T.StringType())]
    return parts.open_parts(spark, _sums_path(table), T.StructType(kinds), "source", parts.current(spark, table))


def open_facts(spark: SparkSession, table: str) -> DataFrame:
    """The fact table with its source, by declared schema: also right while it has no rows."""
    return open_sources(spark, table, PAYMENTS)


def open_rejects(spark: SparkSession, table: str, rejects_table: str) -> DataFrame:
    """The rejects of the loads that count in the fact table, with their source."""
    full = T.StructType([*REJECTS.fields, T.StructField("source", T.StringType())])
    return parts.open_parts(spark, rejects_table, full, "source", parts.current(spark, table))


def ingest(
    spark: SparkSession,
    paths: Mapping[str, str],
    dims: Dimensions,
    table: str,
    rejects_table: str,
    first: int = 2014,
    last: int = 2023,
    nutrition_last: int = 2024,
) -> Load:
    """Load every given source; other sources of the tables stay, and loading one again replaces its rows.

    The entity dimension is built once, as a table. The sources just loaded are
    checked against all constraints of the fact table in one scan; an audit of
    the whole table is ``broken_rules(load.facts, dims)``.
    """
    entities = scratch_path(spark, "entities")
    entity_dimension(dims).write.parquet(entities)
    sources = read_sources(spark, paths, first, last, nutrition_last)
    for name, source in sources.items():
        load_source(name, source, dims, spark.read.parquet(entities), table, rejects_table)
    facts = open_facts(spark, table)
    loaded = facts.where(F.col("source").isin(list(sources))).drop("source")
    broken = {row.rule: row.broken for row in broken_rules(loaded, dims).collect()}
    return Load(facts, open_rejects(spark, table, rejects_table), broken)
