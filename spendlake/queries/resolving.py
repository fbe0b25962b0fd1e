"""Reshapes, joins, set operations and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendlake.functions import scalars as S
from spendlake.operators import combine, joins, reshape
from spendlake.operators.ordering import numbered, order_by_code, rank_report
from spendlake.plans import reports
from spendlake.queries import Registry
from spendlake.queries.proxies import (
    CELLS_SQL,
    DIMENSIONS_SQL,
    ENTITY_TYPES,
    FLAGS,
    GRID_SQL,
    GROUP_MEASURES,
    GROUPS,
    NATION_CODES,
    cells,
    dimensions,
    doubles,
    grouped_wide,
    payments,
    payments_sql,
    supplier_lines,
    table,
    wide,
    stored,
)

QUERIES = Registry()


# Reshape -------------------------------------------------------------------


@QUERIES.add(
    "wide_to_long",
    "R1",
    f"""SELECT state_code, grid.year, 'flag A' AS entity_name, 'program' AS entity_type,
               CAST(amount AS DOUBLE) AS amount
        FROM ({GRID_SQL}) grid JOIN (SELECT DISTINCT n_name FROM ({CELLS_SQL})) USING (n_name)
             LEFT JOIN (SELECT n_name, year, sum(amount) AS amount FROM ({CELLS_SQL}) GROUP BY ALL) sums
             ON sums.n_name = grid.n_name AND sums.year = grid.year""",
)
def wide_to_long(spark: SparkSession, sf: str) -> DataFrame:
    by_year = wide(cells(spark, sf), "amount", name="state_name")
    long = reshape.wide_to_long(
        by_year, 1995, 2001, "flag A", "Total Payment", codes=NATION_CODES, types=ENTITY_TYPES
    )
    return doubles(long, "amount")


@QUERIES.add(
    "stack_groups",
    "R2",
    f"""SELECT n_name AS state, CAST(g.year AS INT) AS year, 'flag ' || flag AS entity_name,
               'sub_program' AS entity_type, CAST(amount AS DOUBLE) AS amount, lines AS contract_count,
               CAST(quantity AS DOUBLE) AS base_acres
        FROM (SELECT DISTINCT n_name, year FROM ({CELLS_SQL})) g
             CROSS JOIN (VALUES ('A'), ('N'), ('R')) AS flags(flag)
             LEFT JOIN ({CELLS_SQL}) USING (n_name, year, flag)""",
)
def stack_groups(spark: SparkSession, sf: str) -> DataFrame:
    stacked = reshape.stack_groups(grouped_wide(cells(spark, sf)), ["year", "state"], GROUPS, GROUP_MEASURES)
    return doubles(stacked, "amount", "base_acres")


# Joins ---------------------------------------------------------------------


@QUERIES.add(
    "combine_measures",
    "J1",
    f"""SELECT n_name, year, CAST(sum(amount) AS DOUBLE) AS amount,
               CASE WHEN year % 2 = 1 THEN CAST(sum(lines) AS BIGINT) END AS lines,
               CAST(sum(quantity) AS DOUBLE) AS quantity
        FROM ({CELLS_SQL}) GROUP BY n_name, year""",
)
def combine_measures(spark: SparkSession, sf: str) -> DataFrame:
    sums = cells(spark, sf)
    keyed = sums.groupBy("n_name", "year")
    lines = sums.where("year % 2 = 1").groupBy("n_name", "year").agg(F.sum("lines").alias("lines"))
    combined = joins.combine_measures(
        keyed.agg(F.sum("amount").alias("amount")),
        lines,
        keyed.agg(F.sum("quantity").alias("quantity")),
        keys=["n_name", "year"],
    )
    return doubles(combined, "amount", "quantity")


@QUERIES.add(
    "resolve_subtitle",
    "J2",
    f"""WITH {DIMENSIONS_SQL}
        SELECT c_custkey, n_name AS entity_name, title_id, subtitle_id
        FROM customer JOIN nation ON c_nationkey = n_nationkey
             JOIN entities ON entity_type = 'subtitle' AND entity_name = n_name
        WHERE n_nationkey < 20""",
)
def resolve_subtitle(spark: SparkSession, sf: str) -> DataFrame:
    spelled = F.when(F.col("n_nationkey") < 20, F.col("n_name")).otherwise(F.concat(F.lit("X"), "n_name"))
    nation = table(spark, sf, "nation").select("n_nationkey", spelled.alias("entity_name"))
    rows = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joins.resolve_subtitle(rows.select("c_custkey", "entity_name"), dimensions(spark, sf))


def _named_lines(spark: SparkSession, sf: str, *parts: str) -> DataFrame:
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    lines = table(spark, sf, "lineitem").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    known = F.when(F.col("l_linenumber") > 1, F.concat_ws("/", *parts)).otherwise("no such name")
    return lines.select("l_orderkey", "l_linenumber", known.alias("entity_name"))


def _resolved_sql(kind: str, name: str, *ids: str) -> str:
    return f"""WITH {DIMENSIONS_SQL}
        SELECT l_orderkey, l_linenumber, entity_name, {', '.join(ids)}
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
             JOIN entities ON entity_type = '{kind}' AND entity_name = {name}
        WHERE l_linenumber > 1"""


@QUERIES.add("resolve_program", "J3", _resolved_sql("program", "s_name", "title_id", "subtitle_id", "program_id"))
def resolve_program(spark: SparkSession, sf: str) -> DataFrame:
    return joins.resolve_program(_named_lines(spark, sf, "s_name"), dimensions(spark, sf))


@QUERIES.add(
    "resolve_sub_program",
    "J4",
    _resolved_sql(
        "sub_program", "s_name || '/' || l_returnflag", "title_id", "subtitle_id", "program_id", "sub_program_id"
    ),
)
def resolve_sub_program(spark: SparkSession, sf: str) -> DataFrame:
    return joins.resolve_sub_program(_named_lines(spark, sf, "s_name", "l_returnflag"), dimensions(spark, sf))


@QUERIES.add(
    "resolve_sub_sub_program",
    "J5",
    _resolved_sql(
        "sub_sub_program", "s_name || '/' || l_returnflag || '/' || l_linestatus", *joins.ENTITY_IDS
    ),
)
def resolve_sub_sub_program(spark: SparkSession, sf: str) -> DataFrame:
    rows = _named_lines(spark, sf, "s_name", "l_returnflag", "l_linestatus")
    return joins.resolve_sub_sub_program(rows, dimensions(spark, sf))


def mixed_entities(lines: DataFrame) -> DataFrame:
    """Supplier line items named at each level in turn, and some with unknown types or names."""
    turn = F.col("l_linenumber") % 6
    kind = (
        F.when(turn == 0, "subtitle")
        .when(turn == 2, "sub_program")
        .when(turn == 3, "sub_sub_program")
        .when(turn == 4, "county")
        .otherwise("program")
    )
    name = (
        F.when(turn == 0, F.col("n_name"))
        .when(turn == 2, F.concat_ws("/", "s_name", "l_returnflag"))
        .when(turn == 3, F.concat_ws("/", "s_name", "l_returnflag", "l_linestatus"))
        .when(turn == 5, F.lit("no such name"))
        .otherwise(F.col("s_name"))
    )
    return lines.withColumns({"entity_type": kind, "entity_name": name})


MIXED_SQL = """
SELECT *, CASE l_linenumber % 6 WHEN 0 THEN 'subtitle' WHEN 2 THEN 'sub_program' WHEN 3 THEN 'sub_sub_program'
               WHEN 4 THEN 'county' ELSE 'program' END AS entity_type,
       CASE l_linenumber % 6 WHEN 0 THEN n_name WHEN 2 THEN s_name || '/' || l_returnflag
            WHEN 3 THEN s_name || '/' || l_returnflag || '/' || l_linestatus WHEN 5 THEN 'no such name'
            ELSE s_name END AS entity_name
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
"""


@QUERIES.add(
    "resolve_entities",
    "J6",
    f"""WITH {DIMENSIONS_SQL}
        SELECT l_orderkey, l_linenumber, entity_type, entity_name, title_id, subtitle_id, program_id,
               sub_program_id, sub_sub_program_id
        FROM ({MIXED_SQL}) JOIN entities USING (entity_type, entity_name)""",
)
def resolve_entities(spark: SparkSession, sf: str) -> DataFrame:
    rows = mixed_entities(supplier_lines(spark, sf)).select("l_orderkey", "l_linenumber", "entity_type", "entity_name")
    return joins.resolve_entities(rows, dimensions(spark, sf))


@QUERIES.add(
    "first_match",
    "J7",
    """SELECT l_orderkey, l_linenumber, p_name, first_partkey
       FROM lineitem JOIN part ON l_partkey = p_partkey
            JOIN (SELECT p_name, min(p_partkey) AS first_partkey FROM part GROUP BY p_name) USING (p_name)""",
)
def first_match(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_name", "p_partkey")
    lines = table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    first = joins.first_match(part, ["p_name"], ["p_partkey"]).withColumnRenamed("p_partkey", "first_partkey")
    named = lines.select("l_orderkey", "l_linenumber", "p_name")
    return named.join(joins.small_side(first), "p_name")


@QUERIES.add(
    "resolve_category",
    "J8",
    f"""WITH {DIMENSIONS_SQL}
        SELECT l_orderkey, l_linenumber, practice_category, facts.program_id, id AS practice_category_id
        FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'F' THEN p_type END AS practice_category,
                     l_suppkey % 3 + 100 AS program_id
              FROM lineitem JOIN part ON l_partkey = p_partkey) facts
             LEFT JOIN practice_categories c ON c.name = practice_category AND c.program_id = facts.program_id""",
)
def resolve_category(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_type")
    lines = table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    rows = lines.select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linestatus") == "F", F.col("p_type")).alias("practice_category"),
        (F.col("l_suppkey") % 3 + 100).alias("program_id"),
    )
    return joins.resolve_category(rows, dimensions(spark, sf).practice_categories)


@QUERIES.add(
    "rejects",
    "J9",
    """SELECT s_nationkey, s_suppkey, 'unknown nation' AS reason FROM supplier
       WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = s_nationkey AND n_nationkey < 20)""",
)
def rejects(spark: SparkSession, sf: str) -> DataFrame:
    nations = table(spark, sf, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("s_nationkey"))
    suppliers = table(spark, sf, "supplier").select("s_nationkey", "s_suppkey")
    return joins.rejects(suppliers, nations, ["s_nationkey"], "unknown nation")


@QUERIES.add(
    "facts_with_dim",
    "J10",
    f"""SELECT r_name AS title_name, CAST(sum(payment) AS DOUBLE) AS payment
        FROM ({payments_sql(hierarchy=True)}) JOIN region ON title_id = r_regionkey + 100 GROUP BY r_name""",
)
def facts_with_dim(spark: SparkSession, sf: str) -> DataFrame:
    sums = payments(spark, sf, hierarchy=True).groupBy("title_id").agg(F.sum("payment").alias("payment"))
    titled = joins.with_name(sums, dimensions(spark, sf).titles, "title_id", "title_name")
    return doubles(titled.groupBy("title_name").agg(F.sum("payment").alias("payment")), "payment")


@QUERIES.add(
    "match_contains",
    "J11",
    """SELECT p_partkey, p_brand, CAST(n_nationkey AS VARCHAR) AS matched_code
       FROM part LEFT JOIN nation ON contains(p_brand, CAST(n_nationkey AS VARCHAR))
       QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY n_nationkey) = 1""",
)
def match_contains(spark: SparkSession, sf: str) -> DataFrame:
    listed = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("code"), "n_nationkey")
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    return joins.match_contains(part, listed, "p_brand", "code", "n_nationkey")


# Set operations ------------------------------------------------------------


@QUERIES.add("union_like", "U1", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def union_like(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    year = F.year("o_orderdate")
    slices = [orders.where(year < 1996), orders.where(year.between(1996, 1998)), orders.where(year > 1998)]
    return combine.union_all(*[part.select("o_orderkey", "o_custkey", "o_totalprice") for part in slices])


@QUERIES.add(
    "union_missing",
    "U2",
    """SELECT c_name AS name, c_mktsegment AS segment, NULL::BIGINT AS s_suppkey FROM customer
       UNION ALL SELECT s_name, NULL, s_suppkey FROM supplier""",
)
def union_missing(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    supplier = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), "s_suppkey")
    return combine.union_missing(customer, supplier)


@QUERIES.add(
    "first_by_key",
    "U3",
    """SELECT p_name, p_partkey, p_brand FROM part
       QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1""",
)
def first_by_key(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_name", "p_partkey", "p_brand")
    return combine.first_by_key(part, ["p_name"], ["p_partkey"])


@QUERIES.add(
    "priority_merge",
    "U4",
    """SELECT p_name, p_partkey, source FROM (
           SELECT p_name, p_partkey, 'first' AS source, 0 AS rank FROM part WHERE p_size % 3 = 0
           UNION ALL SELECT p_name, p_partkey, 'second', 1 FROM part WHERE p_size % 3 = 1
           UNION ALL SELECT p_name, p_partkey, 'third', 2 FROM part WHERE p_size % 3 = 2)
       QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY rank, p_partkey) = 1""",
)
def priority_merge(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    slices = [
        (part.where("p_size % 3 = 0"), "first"),
        (part.where("p_size % 3 = 1"), "second"),
        (part.where("p_size % 3 = 2"), "third"),
    ]
    sources = [(frame.select("p_name", "p_partkey"), tag) for frame, tag in slices]
    return combine.priority_merge(sources, ["p_name"], ["p_partkey"])


# Reports -------------------------------------------------------------------

_BY_TITLE = f"({payments_sql(hierarchy=True, state=True)}) WHERE title_id = 100"


@QUERIES.add(
    "total",
    "A1",
    f"""SELECT CAST(sum(payment) AS DOUBLE) AS total_payments FROM ({payments_sql(hierarchy=True)})
        WHERE title_id = 100 AND year >= 1996 AND year <= 1998""",
)
def total(spark: SparkSession, sf: str) -> DataFrame:
    facts = payments(spark, sf, hierarchy=True, years=(1996, 1998))
    return doubles(reports.total(facts, "title", 100, 1996, 1998), "total_payments")


@QUERIES.add(
    "state_totals",
    "A2",
    f"""SELECT state_code AS state, CAST(sum(payment) AS DOUBLE) AS total_payments
        FROM {_BY_TITLE} AND year >= 1996 AND year <= 1998 GROUP BY state_code ORDER BY 2 DESC""",
)
def state_totals(spark: SparkSession, sf: str) -> DataFrame:
    facts = payments(spark, sf, hierarchy=True, state=True, years=(1996, 1998))
    return doubles(reports.state_totals(facts, "title", 100, 1996, 1998), "total_payments")


_SHARE = "round(CAST(sum(payment) AS DOUBLE) / (SELECT CAST(sum(payment) AS DOUBLE) FROM {scope}) * 100, 2)"
_SHARE_COLUMNS = ["total_payment_in_dollars", "total_payment_in_percentage_nationwide"]


@QUERIES.add(
    "state_share",
    "A3",
    f"""WITH facts AS ({payments_sql(hierarchy=True, state=True)})
        SELECT state_code AS state, r_name AS title_name, CAST(sum(payment) AS DOUBLE) AS total_payment_in_dollars,
               {_SHARE.format(scope="facts WHERE title_id = 100 AND year BETWEEN 1996 AND 1998")}
               AS total_payment_in_percentage_nationwide
        FROM facts JOIN region ON title_id = r_regionkey + 100
        WHERE title_id = 100 AND year BETWEEN 1996 AND 1998 GROUP BY state_code, r_name""",
)
def state_share(spark: SparkSession, sf: str) -> DataFrame:
    facts = payments(spark, sf, hierarchy=True, state=True, years=(1996, 1998))
    titles = dimensions(spark, sf).titles
    return doubles(reports.state_share(facts, titles, "title", 100, 1996, 1998), *_SHARE_COLUMNS)


@QUERIES.add(
    "state_share_open",
    "A4",
    f"""WITH facts AS ({payments_sql(hierarchy=True, state=True)})
        SELECT state_code AS state, n_name AS subtitle_name, CAST(sum(payment) AS DOUBLE) AS total_payment_in_dollars,
               {_SHARE.format(scope="facts WHERE subtitle_id = 100 AND year BETWEEN 1996 AND 1998")}
               AS total_payment_in_percentage_nationwide
        FROM facts JOIN nation ON subtitle_id = n_nationkey + 100
        WHERE subtitle_id = 100 GROUP BY state_code, n_name""",
)
def state_share_open(spark: SparkSession, sf: str) -> DataFrame:
    facts = payments(spark, sf, hierarchy=True, state=True)
    subtitles = dimensions(spark, sf).subtitles
    share = reports.state_share(facts, subtitles, "subtitle", 100, 1996, 1998, bounded=False)
    return doubles(share, *_SHARE_COLUMNS)


@QUERIES.add(
    "report_from_sums",
    "A3",
    f"""WITH facts AS ({payments_sql(hierarchy=True, state=True)}), span AS (SELECT * FROM facts WHERE year BETWEEN 1996 AND 1998)
        SELECT 'share' AS report, state_code AS state, r_name AS name, CAST(sum(payment) AS DOUBLE) AS payments,
               {_SHARE.format(scope="span WHERE title_id = 100")} AS share
        FROM span JOIN region ON title_id = r_regionkey + 100 WHERE title_id = 100 GROUP BY state_code, r_name
        UNION ALL
        SELECT 'state', state_code, NULL, CAST(sum(payment) AS DOUBLE), NULL FROM span WHERE subtitle_id = 107 GROUP BY state_code
        UNION ALL
        SELECT 'program', state_code, s_name, CAST(sum(payment) AS DOUBLE), NULL
        FROM span JOIN supplier ON program_id = s_suppkey + 100 GROUP BY state_code, s_name
        UNION ALL
        SELECT 'total', NULL, NULL, CAST(sum(payment) AS DOUBLE), NULL FROM span WHERE title_id = 100""",
)
def report_from_sums(spark: SparkSession, sf: str) -> DataFrame:
    """Every kind of report, none of which reads the facts again once they are summed."""
    facts = payments(spark, sf, hierarchy=True, state=True)
    lower = [name for name in joins.ENTITY_IDS if name not in facts.columns]
    sums = stored(reports.node_sums(facts.withColumns({name: F.lit(None).cast("int") for name in lower})), "sums")
    dims = dimensions(spark, sf)
    span = (1996, 1998)
    share = reports.state_share(sums, dims.titles, "title", 100, *span)
    found = [
        ("share", share, "state", "title_name", "total_payment_in_dollars", "total_payment_in_percentage_nationwide"),
        ("state", reports.state_totals(sums, "subtitle", 107, *span), "state", None, "total_payments", None),
        ("program", reports.program_state_totals(sums, dims.programs, None, *span), "state", "program_name", "total_payments", None),
        ("total", reports.total(sums, "title", 100, *span), None, None, "total_payments", None),
    ]
    parts = []
    for report, rows, *columns in found:
        kinds = zip(("state", "name", "payments", "share"), columns, ("string", "string", "double", "double"))
        parts.append(rows.select(F.lit(report).alias("report"), *[(F.col(c) if c else F.lit(None)).cast(kind).alias(name) for name, c, kind in kinds]))
    return combine.union_all(*parts)


@QUERIES.add(
    "program_state_totals",
    "A5",
    f"""SELECT state_code AS state, s_name AS program_name, CAST(sum(payment) AS DOUBLE) AS total_payments
        FROM ({payments_sql(hierarchy=True, state=True)}) JOIN supplier ON program_id = s_suppkey + 100
        WHERE program_id = 100 AND year BETWEEN 1996 AND 1998 GROUP BY state_code, s_name""",
)
def program_state_totals(spark: SparkSession, sf: str) -> DataFrame:
    facts = payments(spark, sf, hierarchy=True, state=True, years=(1996, 1998))
    programs = dimensions(spark, sf).programs
    return doubles(reports.program_state_totals(facts, programs, 100, 1996, 1998), "total_payments")


@QUERIES.add(
    "program_state_totals_leaf",
    "A5",
    f"""SELECT state_code AS state, s_name AS program_name, CAST(sum(payment) AS DOUBLE) AS total_payments
        FROM ({payments_sql("l_returnflag", "l_linestatus", hierarchy=True, state=True)})
             JOIN supplier ON program_id = s_suppkey + 100
        WHERE year BETWEEN 1996 AND 1998 AND NOT (l_returnflag IN ('A', 'N') AND l_linestatus = 'F')
        GROUP BY state_code, s_name""",
)
def program_state_totals_leaf(spark: SparkSession, sf: str) -> DataFrame:
    facts = payments(spark, sf, "l_returnflag", "l_linestatus", hierarchy=True, state=True, years=(1996, 1998))
    levels = facts.withColumns(
        {
            "sub_program_id": F.col("program_id") * 3 + S.look_up(F.col("l_returnflag"), {f: i for i, f in enumerate(FLAGS)}),
            "sub_sub_program_id": F.when(F.col("l_linestatus") == "O", F.col("program_id") * 3),
        }
    )
    dims = dimensions(spark, sf)
    # Flags A and N of each program stand for roll-up rows.
    subs = table(spark, sf, "supplier").select(
        F.explode(F.array(*[((F.col("s_suppkey") + 100) * 3 + i) for i in (0, 1)])).alias("id"),
        F.lit("Total CRP").alias("name"),
    )
    totals = reports.program_state_totals(levels, dims.programs, None, 1996, 1998, leaf_sub_programs=subs)
    return doubles(totals, "total_payments")


# Sorts ---------------------------------------------------------------------


def place_in_output(report: DataFrame, measure: str) -> DataFrame:
    """The rows of a report in the order they come, numbered; equal values share the first place among them."""
    return numbered(report).withColumn("position", F.min("position").over(Window.partitionBy(measure)))


def _ranked(level: str, *extra: str) -> str:
    return f"""SELECT state_code AS state, CAST(sum(payment) AS DOUBLE) AS total_payments,
                       rank() OVER (ORDER BY sum(payment) DESC NULLS FIRST) AS position
                FROM ({payments_sql(*extra, hierarchy=True, state=True)})
                WHERE {level} AND year BETWEEN 1996 AND 1998 GROUP BY state_code"""


@QUERIES.add("state_totals_subtitle", "A2", _ranked("subtitle_id = 103"))
def state_totals_subtitle(spark: SparkSession, sf: str) -> DataFrame:
    facts = payments(spark, sf, hierarchy=True, state=True, years=(1996, 1998))
    totals = place_in_output(reports.state_totals(facts, "subtitle", 103, 1996, 1998), "total_payments")
    return doubles(totals, "total_payments")


@QUERIES.add("state_totals_sub_program", "A2", _ranked("program_id = 102 AND l_returnflag = 'R'", "l_returnflag"))
def state_totals_sub_program(spark: SparkSession, sf: str) -> DataFrame:
    lines = payments(spark, sf, "l_returnflag", hierarchy=True, state=True, years=(1996, 1998))
    place = F.array_position(F.array(*[F.lit(flag) for flag in FLAGS]), F.col("l_returnflag")) - 1
    facts = lines.withColumn("sub_program_id", (F.col("program_id") - 100) * 3 + place + 100)
    totals = place_in_output(reports.state_totals(facts, "sub_program", 2 * 3 + 2 + 100, 1996, 1998), "total_payments")
    return doubles(totals, "total_payments")


@QUERIES.add(
    "rank_report",
    "O1",
    f"""SELECT state, total_payments, rank() OVER (ORDER BY total_payments DESC NULLS FIRST) AS position
        FROM (SELECT s_name AS state, CAST(CASE WHEN s_name NOT LIKE '%3' THEN sum(payment) END AS DOUBLE)
                     AS total_payments
              FROM ({payments_sql(hierarchy=True)}) JOIN supplier ON program_id = s_suppkey + 100 GROUP BY s_name)""",
)
def rank_of_report(spark: SparkSession, sf: str) -> DataFrame:
    facts = payments(spark, sf, hierarchy=True)
    programs = dimensions(spark, sf).programs
    sums = facts.groupBy("program_id").agg(F.sum("payment").alias("payment"))
    named = joins.with_name(sums, programs, "program_id", "state").select(
        "state", F.when(~F.col("state").like("%3"), F.col("payment")).cast("double").alias("total_payments")
    )
    return place_in_output(rank_report(named, "total_payments"), "total_payments")


@QUERIES.add(
    "order_by_code",
    "O2",
    """SELECT practice_code, row_number() OVER (ORDER BY practice_code) AS position
       FROM (SELECT DISTINCT p_brand || '-' || CAST(p_partkey % 700 AS VARCHAR) AS practice_code FROM part)""",
)
def order_of_codes(spark: SparkSession, sf: str) -> DataFrame:
    code = F.concat_ws("-", "p_brand", (F.col("p_partkey") % 700).cast("string"))
    codes = table(spark, sf, "part").select(code.alias("practice_code")).distinct()
    return numbered(order_by_code(codes))
