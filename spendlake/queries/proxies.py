"""Spending tables derived from the driver's star schema.

Payments are line items: the program hierarchy is the supplier side (region,
nation, supplier), the state is the nation of the customer or supplier. Only
the joins a query needs are built; ``payments_sql`` builds the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spendlake.operators.joins import Dimensions
from spendlake.session import scratch_path, tune

FLAGS = ["A", "N", "R"]
STATUSES = ["F", "O"]
YEARS = list(range(1995, 2002))
# The nation tables always hold 25 nations; their codes follow from the key.
NATION_CODES = {f"NATION_{key}": f"{key:02d}" for key in range(25)}
NATION_NAMES = {code: name for name, code in NATION_CODES.items()}
ENTITY_TYPES = {"program": [f"flag {flag}" for flag in FLAGS]}


# Schemas by path, so that only the first use of a table reads a footer for it.
_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    tune(spark)
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def doubles(df: DataFrame, *columns: str) -> DataFrame:
    """Decimals as doubles: the two engines name decimal types differently."""
    return df.withColumns({name: F.col(name).cast("double") for name in columns})


def money(column: str) -> Column:
    return F.col(column).cast("decimal(14,2)")


def stored(df: DataFrame, name: str) -> DataFrame:
    """A table in the shared folder, for a small result that several frames start from."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def payments(
    spark: SparkSession,
    sf_dir: str,
    *extra: str,
    hierarchy: bool = False,
    state: bool = False,
    part: bool = False,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Line items as payments, with the parts asked for and further line item columns.

    ``years`` bounds the ship dates, a range that reaches the scan.
    """
    lines = table(spark, sf_dir, "lineitem")
    if years:
        first, last = (F.lit(f"{year}-01-01").cast(lines.schema["l_shipdate"].dataType) for year in (years[0], years[1] + 1))
        lines = lines.where((F.col("l_shipdate") >= first) & (F.col("l_shipdate") < last))
    columns = [
        F.col("l_orderkey"),
        F.col("l_linenumber"),
        F.year("l_shipdate").alias("year"),
        money("l_extendedprice").alias("payment"),
        *[F.col(name) for name in extra],
    ]
    nation = table(spark, sf_dir, "nation")
    if hierarchy:
        # One table at a time: the planner knows the size of a table, not of a join.
        supplier = table(spark, sf_dir, "supplier")
        home = nation.select(
            F.col("n_nationkey").alias("home_key"),
            (F.col("n_regionkey") + 100).alias("title_id"),
            (F.col("n_nationkey") + 100).alias("subtitle_id"),
        )
        lines = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        lines = lines.join(home, F.col("s_nationkey") == F.col("home_key"))
        columns += [F.col("title_id"), F.col("subtitle_id"), (F.col("s_suppkey") + 100).alias("program_id")]
    if state:
        placed = (
            table(spark, sf_dir, "orders")
            .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("o_orderkey", F.col("n_name").alias("state_code"))
        )
        lines = lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        columns.append(F.col("state_code"))
    if part:
        kinds = table(spark, sf_dir, "part").select(
            "p_partkey", F.col("p_type").alias("category"), F.col("p_brand").alias("code")
        )
        lines = lines.join(kinds, F.col("l_partkey") == F.col("p_partkey"))
        columns += [F.col("category"), F.col("code")]
    return lines.select(columns)


def payments_sql(*extra: str, hierarchy: bool = False, state: bool = False, part: bool = False) -> str:
    columns = [
        "l_orderkey",
        "l_linenumber",
        "CAST(year(l_shipdate) AS INT) AS year",
        "CAST(l_extendedprice AS DECIMAL(14,2)) AS payment",
        *extra,
    ]
    joins = []
    if hierarchy:
        columns += [
            "sn.n_regionkey + 100 AS title_id",
            "sn.n_nationkey + 100 AS subtitle_id",
            "s_suppkey + 100 AS program_id",
        ]
        joins.append("JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey")
    if state:
        columns.append("cn.n_name AS state_code")
        joins.append(
            "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
            "JOIN nation cn ON c_nationkey = cn.n_nationkey"
        )
    if part:
        columns += ["p_type AS category", "p_brand AS code"]
        joins.append("JOIN part ON l_partkey = p_partkey")
    return f"SELECT {', '.join(columns)} FROM lineitem {' '.join(joins)}"


def supplier_lines(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Line items, or those given, with the nation of their supplier."""
    if lines is None:
        lines = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .withColumns({"year": F.year("l_shipdate"), "price": money("l_extendedprice")})
    )


SUPPLIER_LINES_SQL = (
    "SELECT *, CAST(year(l_shipdate) AS INT) AS year, CAST(l_extendedprice AS DECIMAL(14,2)) AS price "
    "FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"
)


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums per nation, year and return flag: the table behind every wide layout."""
    return stored(
        supplier_lines(spark, sf_dir)
        .groupBy("n_name", "year", F.col("l_returnflag").alias("flag"))
        .agg(
            F.sum("price").alias("amount"),
            F.sum(F.col("l_quantity").cast("decimal(14,2)")).alias("quantity"),
            F.count(F.lit(1)).alias("lines"),
        ),
        "cells",
    )


CELLS_SQL = f"""
SELECT n_name, year, l_returnflag AS flag, sum(price) AS amount,
       sum(CAST(l_quantity AS DECIMAL(14,2))) AS quantity, count(*) AS lines
FROM ({SUPPLIER_LINES_SQL}) GROUP BY ALL
"""


def wide(sums: DataFrame, measure: str, key: str = "n_name", name: str = "State Name") -> DataFrame:
    """One row per state, one column per year."""
    return sums.groupBy(F.col(key).alias(name)).pivot("year", YEARS).agg(F.sum(measure))


# Every known nation with every year.
GRID_SQL = "SELECT n_name, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state_code, CAST(year AS INT) AS year FROM nation CROSS JOIN range(1995, 2002) AS span(year)"


def grouped_wide(sums: DataFrame) -> DataFrame:
    """Nation and year with three column groups, named ``<flag> - <measure>``."""
    measures = {"AMOUNT ($1000)": "amount", "LINES": "lines", "QUANTITY": "quantity"}
    columns = [
        F.sum(F.when(F.col("flag") == flag, F.col(measure))).alias(f"{flag} - {suffix}")
        for flag in FLAGS
        for suffix, measure in measures.items()
    ]
    return sums.groupBy("year", F.col("n_name").alias("state")).agg(*columns)


GROUPS = [(flag, f"flag {flag}", "sub_program") for flag in FLAGS]
GROUP_MEASURES = {"AMOUNT ($1000)": "amount", "LINES": "contract_count", "QUANTITY": "base_acres"}


def padded_code(key: str) -> Column:
    return F.lpad(F.col(key).cast("string"), 2, "0")


def dimensions(spark: SparkSession, sf_dir: str) -> Dimensions:
    """Region, nation and supplier as the program tree, with two levels below the supplier.

    One nation, one part type and some practice codes are left out, so facts can miss.
    """
    nation = table(spark, sf_dir, "nation")
    supplier = table(spark, sf_dir, "supplier")
    part = table(spark, sf_dir, "part")
    suppliers = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    flags = F.posexplode(F.array(*[F.lit(flag) for flag in FLAGS])).alias("place", "flag")
    subs = supplier.select("s_suppkey", "s_name", flags).select(
        (F.col("s_suppkey") * 3 + F.col("place") + 100).alias("id"),
        (F.col("s_suppkey") + 100).alias("program_id"),
        F.concat_ws("/", "s_name", "flag").alias("name"),
    )
    statuses = F.posexplode(F.array(*[F.lit(status) for status in STATUSES])).alias("place", "status")
    sub_subs = subs.select("id", "name", statuses).select(
        ((F.col("id") - 100) * 2 + F.col("place") + 100).alias("id"),
        F.col("id").alias("sub_program_id"),
        F.concat_ws("/", "name", "status").alias("name"),
    )
    kinds = part.where("p_type <> 'PROMO'").groupBy("p_type").agg(F.min("p_partkey").alias("kind"))
    categories = kinds.select("p_type", "kind", F.explode(F.sequence(F.lit(100), F.lit(102))).alias("program_id")).select(
        (F.col("kind") * 3 + F.col("program_id")).alias("id"),
        F.col("p_type").alias("name"),
        F.col("program_id").cast("long").alias("program_id"),
    )
    practices = (
        part.where("p_partkey % 700 < 600")
        .select((F.col("p_partkey") % 700).alias("k"))
        .distinct()
        .select(
            F.when(F.col("k") >= 100, F.col("k").cast("string"))
            .otherwise(F.concat(F.lit("E"), F.col("k").cast("string"), F.lit("X")))
            .alias("code")
        )
    )
    return Dimensions(
        states=nation.where("n_nationkey < 24").select(
            padded_code("n_nationkey").alias("code"), F.col("n_name").alias("name")
        ),
        titles=table(spark, sf_dir, "region").select(
            (F.col("r_regionkey") + 100).alias("id"), F.col("r_name").alias("name")
        ),
        subtitles=nation.select(
            (F.col("n_nationkey") + 100).alias("id"),
            (F.col("n_regionkey") + 100).alias("title_id"),
            F.col("n_name").alias("name"),
        ),
        programs=suppliers.select(
            (F.col("s_suppkey") + 100).alias("id"),
            (F.col("n_regionkey") + 100).alias("title_id"),
            (F.col("n_nationkey") + 100).alias("subtitle_id"),
            F.col("s_name").alias("name"),
        ),
        sub_programs=subs,
        sub_sub_programs=sub_subs,
        practice_categories=categories,
        practices=practices,
    )


# The same dimensions as SQL common table expressions.
DIMENSIONS_SQL = """
titles AS (SELECT r_regionkey + 100 AS id, r_name AS name FROM region),
subtitles AS (SELECT n_nationkey + 100 AS id, n_regionkey + 100 AS title_id, n_name AS name FROM nation),
programs AS (SELECT s_suppkey + 100 AS id, n_regionkey + 100 AS title_id, n_nationkey + 100 AS subtitle_id,
                    s_name AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey),
sub_programs AS (SELECT s_suppkey * 3 + place + 100 AS id, s_suppkey + 100 AS program_id,
                        s_name || '/' || flag AS name
                 FROM supplier CROSS JOIN (VALUES (0, 'A'), (1, 'N'), (2, 'R')) AS flags(place, flag)),
sub_sub_programs AS (SELECT (id - 100) * 2 + place + 100 AS id, id AS sub_program_id, name || '/' || status AS name
                     FROM sub_programs CROSS JOIN (VALUES (0, 'F'), (1, 'O')) AS statuses(place, status)),
practice_categories AS (SELECT kind * 3 + k AS id, p_type AS name, k AS program_id
                        FROM (SELECT p_type, min(p_partkey) AS kind FROM part WHERE p_type <> 'PROMO' GROUP BY p_type)
                             CROSS JOIN range(100, 103) AS span(k)),
entities AS (
    SELECT 'subtitle' AS entity_type, name AS entity_name, title_id, id AS subtitle_id, NULL AS program_id,
           NULL AS sub_program_id, NULL AS sub_sub_program_id FROM subtitles
    UNION ALL
    SELECT 'program', name, title_id, subtitle_id, id, NULL, NULL FROM programs
    UNION ALL
    SELECT 'sub_program', s.name, p.title_id, p.subtitle_id, p.id, s.id, NULL
    FROM sub_programs s JOIN programs p ON p.id = s.program_id
    UNION ALL
    SELECT 'sub_sub_program', ss.name, p.title_id, p.subtitle_id, p.id, s.id, ss.id
    FROM sub_sub_programs ss JOIN sub_programs s ON s.id = ss.sub_program_id JOIN programs p ON p.id = s.program_id)
"""
