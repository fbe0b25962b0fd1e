"""Fact load: payment rows of any source to resolved, typed facts, and rejects with a reason.

All look-ups are joins against small dimensions in one pass over the payments,
which are never shuffled for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake import schemas
from spendlake.fixed_values import ENTITY_TYPES
from spendlake.functions.scalars import nan_to_null, named, normalise_code
from spendlake.operators.columns import storage_value
from spendlake.operators.combine import union_all
from spendlake.operators.joins import (
    BROADCAST_ROWS,
    ENTITY_IDS,
    Dimensions,
    keyed_side,
    resolve_category,
    small_entity_dimension,
)
from spendlake.operators.quality import (
    check_fk,
    check_length,
    check_not_null,
    check_pk,
    check_unique,
    misfit,
)
from spendlake.session import scratch_path

# Stored for every entity type, as payment source column -> fact column.
_COMMON = {
    "amount": "payment",
    "recipient_count": "recipient_count",
    "base_acres": "base_acres",
    "farm_count": "farm_count",
    "contract_count": "contract_count",
}
# Stored for rows at program level only.
_PROGRAM_NUMBERS = [
    "premium_policy_count",
    "liability_amount",
    "premium_amount",
    "premium_subsidy_amount",
    "indemnity_amount",
    "farmer_premium_amount",
    "loss_ratio",
    "net_farmer_benefit_amount",
]
_PROGRAM_TEXTS = ["practice_category", "practice_code"]
_WHOLE_NUMBERS = ["recipient_count", "farm_count", "contract_count", *[n for n in _PROGRAM_NUMBERS if n != "loss_ratio"]]
# Rows equal in everything that one task numbers.
_PIECE = 10_000
# What tells the facts of one source apart.
_NATURAL_KEY = [*ENTITY_IDS, "practice_category_id", "practice_code_variant", "state_code", "year"]


def _known_columns(payments: DataFrame) -> DataFrame:
    """The columns a fact can take; absent ones null, NaN as null, program-only ones nulled elsewhere."""
    kinds = {field.name: field.dataType for field in payments.schema.fields}
    at_program = F.col("entity_type") == "program"

    def column(name: str, missing: T.DataType, program_only: bool):
        if name not in kinds:
            return F.lit(None).cast(missing).alias(name)
        value = named(name)
        if isinstance(kinds[name], (T.DoubleType, T.FloatType)):
            value = nan_to_null(value)
        return (F.when(at_program, value) if program_only else value).alias(name)

    texts = [column(name, T.StringType(), True).cast("string").alias(name) for name in _PROGRAM_TEXTS]
    return payments.select(
        "entity_type",
        "entity_name",
        "state_code",
        "year",
        *[column(name, schemas.SOURCE_NUMBER, False) for name in _COMMON],
        *[column(name, schemas.SOURCE_NUMBER, True) for name in _PROGRAM_NUMBERS],
        *texts,
    )


def judge_payments(payments: DataFrame, dims: Dimensions, entities: DataFrame | None = None) -> DataFrame:
    """Payments with their ids and a ``reason`` why a row cannot be stored, null where it can.

    ``entities`` is the entity dimension where the caller has it at hand.
    """
    entities = small_entity_dimension(dims) if entities is None else keyed_side(entities)
    entities = entities.withColumn("_known", F.lit(True))
    rows = _known_columns(payments).join(entities, ["entity_type", "entity_name"], "left")
    rows = resolve_category(rows, dims.practice_categories)
    rows = rows.withColumns(
        {
            "practice_code_variant": F.col("practice_code"),
            "practice_code": normalise_code(F.col("practice_code")),
        }
    )
    states = dims.states.select(F.col("code").alias("state_code"), F.lit(True).alias("_state")).distinct()
    practices = dims.practices.select(F.col("code").alias("practice_code"), F.lit(True).alias("_practice")).distinct()
    rows = rows.join(states, "state_code", "left").join(practices, "practice_code", "left")
    reason = (
        F.when(~F.coalesce(F.col("entity_type").isin(list(ENTITY_TYPES)), F.lit(False)), "unknown entity type")
        .when(F.col("_known").isNull(), "unknown entity name")
        .when(
            F.col("practice_category").isNotNull() & F.col("practice_category_id").isNull(),
            "unknown practice category",
        )
        .when(F.col("state_code").isNull(), "state code missing")
        .when(F.col("_state").isNull(), "unknown state code")
        .when(F.col("year").isNull(), "year missing")
        .when(F.length("practice_code_variant") > 100, "practice code too long")
        .when(F.col("practice_code").isNotNull() & F.col("_practice").isNull(), "unknown practice code")
        .when(misfit(F.col("amount"), 14, 2), "payment too large")
        .when(misfit(F.col("base_acres"), 10, 2), "base acres too large")
        .when(misfit(F.col("loss_ratio"), 28, 10), "loss ratio too large")
    )
    for column in _WHOLE_NUMBERS:
        reason = F.coalesce(reason, F.when(misfit(F.col(column), 18, 0), f"{column} too large"))
    return rows.withColumn("reason", reason).drop("_known", "_state", "_practice")


def fact_id(source: str, repeat: Column) -> Column:
    """A number that the source and the natural key decide, and ``repeat`` where a key repeats (-1 elsewhere).

    Absent values take part, so a key of one level never equals one of another.
    """
    key = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in _NATURAL_KEY]
    return F.xxhash64(F.lit(source), *key, repeat).bitwiseAND(F.lit((1 << 63) - 1))


def _told_apart(rows: DataFrame) -> DataFrame:
    """The rows with ``_repeat``: -1 where the natural key is theirs alone, else what tells them from rows of equal key.

    That is a hash of all the row holds, and of a number for rows that are equal
    in everything. Nothing of it depends on the order or the split of the input,
    so a load of the same rows gives the same ids. Equal rows are counted, one
    row per task, and dealt out again in pieces, so a hot one is no burden.

    Keys are counted by their hash. Two keys of one hash only make rows count
    as repeated that need not.
    """
    spark, names = rows.sparkSession, rows.columns
    keyed = rows.withColumn("_key", F.xxhash64(*[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in _NATURAL_KEY]))
    path = scratch_path(spark, "repeated-keys")
    counted = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows"))
    counted.where("_rows > 1").write.parquet(path)
    repeated = spark.read.schema("_key long, _rows long").parquet(path)
    if repeated.isEmpty():
        return rows.withColumn("_repeat", F.lit(-1).cast("long"))
    few = repeated.count() <= BROADCAST_ROWS
    # At most one key for so many rows, and no row is more often than its key.
    hot = repeated.where(F.col("_rows") > _PIECE).select("_key")
    chosen = F.broadcast(repeated.select("_key")) if few else keyed_side(hot)
    equal = keyed.join(chosen, "_key", "left_semi").groupBy(*names).agg(F.count(F.lit(1)).alias("_rows"))
    pieces = equal.select("*", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("_rows") - 1).cast("long"), F.lit(_PIECE))).alias("_first"))
    # What a hot row has beyond its first piece goes to other tasks; the others stay where they were counted.
    spread = pieces.where("_first = 0").unionByName(pieces.where("_first > 0").repartition(F.xxhash64("_first", *names)))
    last = F.least(F.col("_first") + _PIECE, F.col("_rows")) - 1
    dealt = spread.select(*names, F.explode(F.sequence("_first", last)).alias("_number"))
    content = F.xxhash64(*[F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in names], F.col("_number"))
    dealt = dealt.select(*names, content.alias("_repeat"))
    if few:
        alone = keyed.join(chosen, "_key", "left_anti")
        return alone.select(*names, F.lit(-1).cast("long").alias("_repeat")).unionByName(dealt)
    # Rows of many repeated keys are shuffled once, by key, which also brings equal rows together.
    again = keyed_side(repeated.where(F.col("_rows") <= _PIECE).select("_key", F.lit(True).alias("_again")))
    others = keyed if hot.isEmpty() else keyed.join(chosen, "_key", "left_anti")
    found = others.join(again, "_key", "left").groupBy("_key", "_again", *names).agg(F.count(F.lit(1)).alias("_rows"))
    numbered = found.select("_again", *names, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rows") - 1)).alias("_number"))
    told = numbered.select(*names, F.when(F.col("_again"), content).otherwise(F.lit(-1).cast("long")).alias("_repeat"))
    return told if hot.isEmpty() else told.unionByName(dealt)


def accepted(judged: DataFrame, source: str = "") -> DataFrame:
    """Storable rows in the fact schema; ids are the same whenever the same rows are loaded."""
    sources = {fact: source for source, fact in _COMMON.items()}
    rows = _told_apart(judged.where("reason IS NULL"))

    def column(field: T.StructField):
        if field.name == "id":
            return fact_id(source, F.col("_repeat")).alias("id")
        held = sources.get(field.name, field.name)
        have = judged.schema[held].dataType
        return storage_value(named(held), have, field.dataType, strict=True).alias(field.name)

    return rows.select([column(field) for field in schemas.PAYMENTS.fields])


def rejected(judged: DataFrame) -> DataFrame:
    """Rows left out of the facts, as they came, with the reason."""
    return judged.where("reason IS NOT NULL").drop(*ENTITY_IDS, "practice_category_id")


def load_facts(payments: DataFrame, dims: Dimensions, source: str = "") -> tuple[DataFrame, DataFrame]:
    judged = judge_payments(payments, dims)
    return accepted(judged, source), rejected(judged)


def check_facts(facts: DataFrame, dims: Dimensions) -> dict[str, DataFrame]:
    """Every constraint on the fact table by name, with the rows that break it."""
    checks = {
        "primary key": check_pk(facts, ["id"]),
        "unique node, state and year": check_unique(facts, schemas.PAYMENT_UNIQUE),
        "state and year present": check_not_null(facts, ["state_code", "year"]),
    }
    for column, (dimension, key) in schemas.PAYMENT_REFERENCES.items():
        checks[f"{column} known"] = check_fk(facts, column, getattr(dims, dimension), key)
    for column, longest in schemas.PAYMENT_LENGTHS.items():
        checks[f"{column} length"] = check_length(facts, column, longest)
    return checks


def broken_rules(facts: DataFrame, dims: Dimensions) -> DataFrame:
    """(rule, broken): for every constraint on the fact table how many rows or keys break it; rules that hold have no row.

    The same numbers as counts of ``check_facts``, from one scan of the facts
    and one shuffle of keys. The dimensions are joined as sets of keys, which
    the planner sends to the facts; each row becomes its two keys and one entry
    for every rule it breaks by itself, and all are counted in one go, entries
    in the map tasks already.
    """
    rows, rules = facts, {}
    rules["state and year present"] = F.col("state_code").isNull() | F.col("year").isNull()
    keys = [getattr(dims, dimension).select(F.col(key).alias(f"_key{n}")) for n, (dimension, key) in enumerate(schemas.PAYMENT_REFERENCES.values())]
    sizes = union_all(*[own.select(F.lit(n).alias("n")) for n, own in enumerate(keys)]).groupBy("n").agg(F.count(F.lit(1)).alias("rows"))
    many = {row.n for row in sizes.collect() if row.rows > BROADCAST_ROWS}
    for n, (column, own) in enumerate(zip(schemas.PAYMENT_REFERENCES, keys)):
        known = own.distinct().withColumn(f"_known{n}", F.lit(True))
        value, key = F.col(column), F.col(f"_key{n}")
        if n in many:
            # Most facts have no value at the lower levels: they meet no key, and the shuffle spreads them.
            spread = F.when(value.isNull(), F.pmod(F.xxhash64("id", *schemas.PAYMENT_UNIQUE), F.lit(_PIECE)) + 1).otherwise(0)
            value, key = F.struct(value.alias("value"), spread.alias("spread")), F.struct(key.alias("value"), F.lit(0).cast("long").alias("spread"))
        rows = rows.join(known.hint("shuffle_hash") if n in many else F.broadcast(known), value == key, "left")
        rules[f"{column} known"] = F.col(column).isNotNull() & F.col(f"_known{n}").isNull()
    for column, longest in schemas.PAYMENT_LENGTHS.items():
        rules[f"{column} length"] = F.length(column) > longest
    bits = sum((F.when(rule, 1 << n).otherwise(0) for n, rule in enumerate(rules.values())), F.lit(0))
    judged = rows.select("id", *schemas.PAYMENT_UNIQUE, bits.alias("_broken"))
    kinds = {field.name: field.dataType for field in facts.schema.fields}

    def entry(rule: str, held: list[str]):
        values = [(F.col(name) if name in held else F.lit(None).cast(kinds[name])).alias(name) for name in ("id", *schemas.PAYMENT_UNIQUE)]
        return F.struct(F.lit(rule).alias("rule"), *values)

    unique = "unique node, state and year"
    complete = ~sum((F.col(name).isNull().cast("int") for name in schemas.PAYMENT_UNIQUE), F.lit(0)).cast("boolean")
    entries = F.array(
        entry("primary key", ["id"]),
        F.when(complete, entry(unique, schemas.PAYMENT_UNIQUE)),
        *[F.when(F.col("_broken").bitwiseAND(1 << n) != 0, entry(rule, [])) for n, rule in enumerate(rules)],
    )
    counted = judged.select(F.inline(F.filter(entries, lambda e: e.isNotNull()))).groupBy("rule", "id", *schemas.PAYMENT_UNIQUE).agg(F.count(F.lit(1)).alias("rows"))
    broken = (
        F.when(F.col("rule") == "primary key", (F.col("id").isNull() | (F.col("rows") > 1)).cast("long"))
        .when(F.col("rule") == unique, (F.col("rows") > 1).cast("long"))
        .otherwise(F.col("rows"))
    )
    return counted.groupBy("rule").agg(F.sum(broken).alias("broken")).where("broken > 0")


def check_dimensions(dims: Dimensions) -> dict[str, DataFrame]:
    """The same for the dimensions."""
    checks = {}
    for name, required in schemas.DIMENSION_REQUIRED.items():
        dimension = getattr(dims, name)
        key = "code" if "code" in dimension.columns else "id"
        checks[f"{name} primary key"] = check_pk(dimension, [key])
        checks[f"{name} values present"] = check_not_null(dimension, required)
        for column, longest in schemas.DIMENSION_LENGTHS.get(name, {}).items():
            checks[f"{name} {column} length"] = check_length(dimension, column, longest)
    checks["titles name unique"] = check_unique(dims.titles, ["name"])
    for (name, column), (parent, key) in schemas.DIMENSION_REFERENCES.items():
        checks[f"{name} {column} known"] = check_fk(getattr(dims, name), column, getattr(dims, parent), key)
    return checks
