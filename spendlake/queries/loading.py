"""Text lists, data checks and whole source-to-facts plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake import schemas
from spendlake.functions.parens import paren_depth as depth_of
from spendlake.functions.scalars import normalise_code
from spendlake.operators import quality
from spendlake.operators.combine import union_all
from spendlake.operators.joins import entity_dimension
from spendlake.operators.ordering import with_position
from spendlake.plans import commodity, conservation, dimensions, facts, insurance, nutrition, practices
from spendlake.plans.ingest import Source, load_source, open_facts, open_rejects
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
    NATION_NAMES,
    SUPPLIER_LINES_SQL,
    cells,
    doubles,
    grouped_wide,
    money,
    padded_code,
    payments,
    stored,
    supplier_lines,
    table,
    wide,
)
from spendlake.queries.proxies import dimensions as proxy_dimensions
from spendlake.queries.resolving import MIXED_SQL, mixed_entities
from spendlake.session import scratch_path
from spendlake.sources.files import read_csv

QUERIES = Registry()


# Text lists ----------------------------------------------------------------


def _lines(part: DataFrame, *pieces) -> DataFrame:
    return part.select(F.col("p_partkey").alias("ord"), F.concat(*pieces).alias("line"))


def _in_parens(column) -> tuple:
    return F.lit(" ("), column, F.lit(")")


@QUERIES.add(
    "parse_national",
    "T1",
    """SELECT p_partkey AS ord, p_name || ' (old)' AS practice_name, p_type AS practice_unit,
              p_brand AS practice_code FROM part""",
)
def parse_national(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    lines = _lines(part, "p_name", F.lit(" (old)"), *_in_parens(F.col("p_type")), *_in_parens(F.col("p_brand")))
    return practices.parse_national(lines)


@QUERIES.add(
    "parse_simple",
    "T2",
    "SELECT p_partkey AS ord, p_name AS practice_name, p_brand AS practice_code FROM part WHERE p_size <> 1",
)
def parse_simple(spark: SparkSession, sf: str) -> DataFrame:
    whole = F.concat("p_name", *_in_parens(F.col("p_brand")))
    line = F.when(F.col("p_size") != 1, whole).otherwise(F.col("p_name"))
    return practices.parse_simple(_lines(table(spark, sf, "part"), line))


def _nested_line():
    return F.concat("p_name", F.lit(" ("), "p_type", *_in_parens(F.col("p_size").cast("string")), F.lit(")"))


@QUERIES.add(
    "paren_depth",
    "T3",
    "SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN -1 WHEN p_size % 7 = 1 THEN 0 ELSE 2 END AS depth FROM part",
)
def paren_depth(spark: SparkSession, sf: str) -> DataFrame:
    turn = F.col("p_size") % 7
    line = (
        F.when(turn == 0, F.left("nested", F.length("nested") - 1))
        .when(turn == 1, F.concat("p_name", F.lit(")")))
        .otherwise(F.col("nested"))
    )
    part = table(spark, sf, "part").withColumn("nested", _nested_line())
    return part.select("p_partkey", depth_of(line).alias("depth"))


def _mixed_lines(spark: SparkSession, sf: str) -> DataFrame:
    turn = F.col("p_size") % 3
    line = (
        F.when(turn == 0, _nested_line())
        .when(turn == 1, F.concat("p_name", *_in_parens(F.col("p_type"))))
        .otherwise(F.col("p_name"))
    )
    return _lines(table(spark, sf, "part"), line)


@QUERIES.add(
    "parse_nested",
    "T4",
    """SELECT p_partkey AS ord, p_name AS practice_name,
              CASE WHEN p_size % 3 = 0 THEN p_type || ' (' || CAST(p_size AS VARCHAR) || ')' ELSE p_type END
              AS practice_code
       FROM part WHERE p_size % 3 <> 2""",
)
def parse_nested(spark: SparkSession, sf: str) -> DataFrame:
    return practices.parse_nested(_mixed_lines(spark, sf))


@QUERIES.add("parse_nested_rejects", "T4", "SELECT p_partkey AS ord, p_name AS line FROM part WHERE p_size % 3 = 2")
def parse_nested_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return practices.nested_rejects(_mixed_lines(spark, sf))


# Data checks ---------------------------------------------------------------


@QUERIES.add(
    "check_pk",
    "D1",
    """SELECT l_orderkey, l_linenumber, count(*) AS row_count, 'duplicate key' AS reason
       FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def check_pk(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_pk(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@QUERIES.add(
    "check_unique",
    "D2",
    """SELECT o_custkey, o_orderstatus AS status, count(*) AS row_count FROM orders
       WHERE o_orderstatus <> 'P' GROUP BY o_custkey, o_orderstatus HAVING count(*) > 1""",
)
def check_unique(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    orders = table(spark, sf, "orders").select("o_custkey", status.alias("status"))
    return quality.check_unique(orders, ["o_custkey", "status"])


@QUERIES.add(
    "check_fk",
    "D3",
    """SELECT c_custkey, c_nationkey FROM customer
       WHERE c_custkey % 50 <> 0 AND NOT EXISTS
             (SELECT 1 FROM nation WHERE n_nationkey = c_nationkey AND n_nationkey < 20)""",
)
def check_fk(spark: SparkSession, sf: str) -> DataFrame:
    nation = F.when(F.col("c_custkey") % 50 != 0, F.col("c_nationkey"))
    customer = table(spark, sf, "customer").select("c_custkey", nation.alias("c_nationkey"))
    return quality.check_fk(customer, "c_nationkey", table(spark, sf, "nation").where("n_nationkey < 20"), "n_nationkey")


@QUERIES.add("check_not_null", "D4", "SELECT p_partkey, NULL::VARCHAR AS kind FROM part WHERE p_size = 1")
def check_not_null(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("p_size") != 1, F.col("p_type"))
    return quality.check_not_null(table(spark, sf, "part").select("p_partkey", kind.alias("kind")), ["p_partkey", "kind"])


@QUERIES.add("check_length", "D5", "SELECT p_partkey, p_name FROM part WHERE length(p_name) > 8")
def check_length(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_length(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", 8)


@QUERIES.add("check_precision", "D6", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 99999.995")
def check_precision(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return quality.check_precision(orders, "o_totalprice", 7, 2)


@QUERIES.add(
    "assign_ids",
    "D7",
    """SELECT CAST(row_number() OVER (ORDER BY s_nationkey, s_suppkey) + 99 AS INT) AS id, s_nationkey, s_suppkey
       FROM supplier""",
)
def assign_ids(spark: SparkSession, sf: str) -> DataFrame:
    supplier = table(spark, sf, "supplier").select("s_nationkey", "s_suppkey")
    return quality.assign_ids(supplier, "s_nationkey", "s_suppkey")


# Source-to-facts plans -----------------------------------------------------


@QUERIES.add(
    "arc_plc_payments",
    "L1",
    f"""WITH cells AS ({CELLS_SQL}), years AS (SELECT unnest(range(1995, 2002)) AS year)
        SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state_code, CAST(g.year AS INT) AS year,
               'flag ' || g.flag AS entity_name, 'program' AS entity_type, CAST(amount AS DOUBLE) AS amount,
               CASE WHEN g.flag <> 'N' THEN CAST(quantity AS DOUBLE) END AS base_acres,
               CAST(lines AS DOUBLE) AS recipient_count
        FROM (SELECT DISTINCT n_name, flag, years.year FROM cells CROSS JOIN years) g
             JOIN nation USING (n_name)
             LEFT JOIN cells ON cells.n_name = g.n_name AND cells.year = g.year AND cells.flag = g.flag""",
)
def arc_plc_payments(spark: SparkSession, sf: str) -> DataFrame:
    sums = cells(spark, sf)

    def by_flag(measure: str, flags: list[str]) -> dict[str, DataFrame]:
        frames = {f"flag {flag}": wide(sums.where(F.col("flag") == flag), measure) for flag in flags}
        return {
            entity: frame.withColumnRenamed("State Name", " State Name ").withColumn("Average", F.lit(0))
            for entity, frame in frames.items()
        }

    result = commodity.arc_plc_payments(
        by_flag("amount", FLAGS),
        by_flag("quantity", ["A", "R"]),
        by_flag("lines", FLAGS),
        1995,
        2001,
        codes=NATION_CODES,
        types=ENTITY_TYPES,
    )
    return doubles(result, "amount", "base_acres", "recipient_count")


_EVENT_LABELS = {"click": "Dairy total", "view": "Dairy total", "signup": "Sign-up relief", "error": "Error relief"}


@QUERIES.add(
    "dairy_disaster_payments",
    "L2",
    """SELECT entity_type, entity_name, state_code, CAST(day AS VARCHAR) AS day,
              CAST(sum(amount) AS DOUBLE) AS amount, CAST(count(recipient_count) AS BIGINT) AS recipients
       FROM (SELECT CASE WHEN event_type IN ('click', 'view') THEN 'subtitle' ELSE 'program' END AS entity_type,
                    CASE event_type WHEN 'click' THEN 'Dairy total' WHEN 'view' THEN 'Dairy total'
                         WHEN 'signup' THEN 'Sign-up relief' WHEN 'error' THEN 'Error relief'
                         ELSE event_type END AS entity_name,
                    CASE WHEN user_id % 30 < 25 THEN lpad(CAST(user_id % 30 AS VARCHAR), 2, '0') END AS state_code,
                    CAST(ts AS DATE) AS day, CAST(value AS DECIMAL(20,8)) AS amount,
                    NULLIF(event_id % 4, 0) AS recipient_count
             FROM events)
       GROUP BY ALL""",
)
def dairy_disaster_payments(spark: SparkSession, sf: str) -> DataFrame:
    count = F.col("event_id") % 4
    rows = table(spark, sf, "events").select(
        F.concat(F.lit("NATION_"), (F.col("user_id") % 30).cast("string"), F.lit(" ")).alias(" state"),
        F.to_date("ts").cast("string").alias("day"),
        F.year("ts").cast("string").alias("year"),
        F.col("event_type").alias("program"),
        F.col("value").cast("string").alias("payments "),
        F.when(count == 0, "").otherwise(count.cast("string")).alias("count"),
    )
    both = commodity.dairy_disaster_payments(
        rows, dairy=["click", "view"], labels=_EVENT_LABELS, names=NATION_NAMES
    )
    sums = both.groupBy("entity_type", "entity_name", "state_code", "day").agg(
        F.sum("amount").alias("amount"), F.count("recipient_count").alias("recipients")
    )
    return doubles(sums, "amount")


def _practice_source(spark: SparkSession, sf: str) -> DataFrame:
    raw_code = F.concat(F.lit("E"), (F.col("l_partkey") % 700).cast("string"), F.lit("X "))
    amount = F.when(F.col("l_discount") != 0, F.col("payment"))
    lines = payments(spark, sf, "l_partkey", "l_discount", state=True, part=True)
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        F.col("year").alias(" Pay_year"),
        F.col("state_code").alias("State "),
        amount.alias("payments"),
        F.col("category").alias("StatutoryCategory"),
        F.col("code").alias("practice_code"),
        raw_code.alias("full_practice_code"),
    )


_PRACTICE_LABELS = {"SMALL": "Small practices", "PROMO": "Small practices"}
# Two nations are unknown here, so their rows drop out.
_PRACTICE_NAMES = {code: name for code, name in NATION_NAMES.items() if code not in ("07", "11")}

_PRACTICE_SQL = """
SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INT) AS year,
       lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state_code, 'EQIP proxy' AS entity_name, 'program' AS entity_type,
       CASE WHEN p_type IN ('SMALL', 'PROMO') THEN 'Small practices' ELSE p_type END AS practice_category,
       'E' || CAST(l_partkey % 700 AS VARCHAR) || 'X' AS practice_code, p_brand AS practice_code_processed,
       CAST(l_extendedprice AS DECIMAL(14,2)) AS amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
WHERE year(l_shipdate) BETWEEN 1996 AND 1999 AND l_discount <> 0 AND n_nationkey NOT IN (7, 11)
"""


def _practice_payments(spark: SparkSession, sf: str) -> DataFrame:
    return conservation.practice_payments(
        _practice_source(spark, sf), "EQIP proxy", 1996, 1999, labels=_PRACTICE_LABELS, names=_PRACTICE_NAMES
    )


@QUERIES.add(
    "practice_payments",
    "L3",
    f"""SELECT l_orderkey, l_linenumber, year, state_code, entity_name, entity_type, practice_category, practice_code,
               practice_code_processed, CAST(amount AS DOUBLE) AS amount,
               CASE WHEN l_code <> '' THEN l_code ELSE practice_code END AS normal_code
        FROM (SELECT *, regexp_extract(practice_code, '(\\d{{3}})', 1) AS l_code FROM ({_PRACTICE_SQL}))""",
)
def practice_payments(spark: SparkSession, sf: str) -> DataFrame:
    rows = _practice_payments(spark, sf).withColumn("normal_code", normalise_code(F.col("practice_code")))
    return doubles(rows, "amount").drop("state_name")


@QUERIES.add(
    "practice_rejects",
    "L3",
    """SELECT reason, count(*) AS row_count FROM (
           SELECT CASE WHEN year(l_shipdate) NOT BETWEEN 1996 AND 1999 THEN 'year out of range'
                       WHEN l_discount = 0 THEN 'amount missing'
                       WHEN c_nationkey IN (7, 11) THEN 'unknown state' END AS reason
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
       WHERE reason IS NOT NULL GROUP BY reason""",
)
def practice_rejects(spark: SparkSession, sf: str) -> DataFrame:
    rows = conservation.practice_rejects(
        _practice_source(spark, sf), 1996, 1999, labels=_PRACTICE_LABELS, names=_PRACTICE_NAMES
    )
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))


_RESERVE_SQL = f"""
SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state_code, CAST(c.year AS INT) AS year,
       'flag ' || flag AS entity_name, 'sub_program' AS entity_type, amount * 1000 AS amount,
       lines AS contract_count, quantity AS base_acres
FROM ({CELLS_SQL}) c JOIN nation USING (n_name) WHERE c.year BETWEEN 1996 AND 1999
"""


def _reserve_payments(spark: SparkSession, sf: str) -> DataFrame:
    # Upper-case names come out in title case, which is what they are looked up by.
    names = {code: name.title() for code, name in NATION_NAMES.items()}
    return conservation.reserve_payments(
        grouped_wide(cells(spark, sf)), 1996, 1999, groups=GROUPS, measures=GROUP_MEASURES, names=names
    )


@QUERIES.add(
    "reserve_payments",
    "L4",
    f"""SELECT state_code, year, entity_name, entity_type, CAST(amount AS DOUBLE) AS amount, contract_count,
               CAST(base_acres AS DOUBLE) AS base_acres FROM ({_RESERVE_SQL})""",
)
def reserve_payments(spark: SparkSession, sf: str) -> DataFrame:
    return doubles(_reserve_payments(spark, sf), "amount", "base_acres").drop("state_name")


_EASEMENT_SQL = f"""
SELECT l_orderkey, l_linenumber, year, CASE n_nationkey WHEN 3 THEN '04' ELSE lpad(CAST(n_nationkey AS VARCHAR), 2, '0')
       END AS state_code, 'ACEP proxy' AS entity_name, 'program' AS entity_type, price AS amount,
       l_linenumber AS contract_count, CAST(l_quantity AS DECIMAL(14,2)) AS base_acres
FROM ({SUPPLIER_LINES_SQL}) WHERE year BETWEEN 1996 AND 1999 AND n_nationkey <> 5
"""


def _easement_payments(spark: SparkSession, sf: str) -> DataFrame:
    # Nation 5 is spelled in a way that only a recode of untrimmed labels would know.
    state = F.when(F.col("n_name") == "NATION_5", "NATION_5/6 ").otherwise(F.concat(F.lit(" "), "n_name", F.lit(" ")))
    rows = supplier_lines(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        "year",
        state.alias("state"),
        F.col("l_linenumber").alias("Number of Contracts"),
        F.col("l_quantity").cast("decimal(14,2)").alias("Number of Acres "),
        (F.col("price") * F.lit("0.001").cast("decimal(4,3)")).alias("Total Financial Assistance Payments ($1000)"),
    )
    labels = {"NATION_3": "NATION_4", "NATION_5/6 ": "NATION_6"}
    return conservation.easement_payments(rows, "ACEP proxy", 1996, 1999, labels=labels, names=NATION_NAMES)


@QUERIES.add(
    "easement_payments",
    "L5",
    f"""SELECT l_orderkey, l_linenumber, year, state_code, entity_name, entity_type, CAST(amount AS DOUBLE) AS amount,
               contract_count, CAST(base_acres AS DOUBLE) AS base_acres FROM ({_EASEMENT_SQL})""",
)
def easement_payments(spark: SparkSession, sf: str) -> DataFrame:
    return doubles(_easement_payments(spark, sf), "amount", "base_acres").drop("state_name")


@QUERIES.add(
    "conservation_union",
    "L6",
    f"""SELECT entity_name, entity_type, state_code, year, count(*) AS row_count, CAST(sum(amount) AS DOUBLE) AS amount,
               CAST(sum(contract_count) AS BIGINT) AS contract_count, count(practice_code) AS coded
        FROM (SELECT entity_name, entity_type, state_code, year, CAST(amount AS DECIMAL(30,8)) AS amount,
                     NULL AS contract_count, practice_code FROM ({_PRACTICE_SQL})
              UNION ALL
              SELECT entity_name, entity_type, state_code, year, amount, contract_count, NULL FROM ({_RESERVE_SQL})
              UNION ALL
              SELECT entity_name, entity_type, state_code, year, amount, contract_count, NULL FROM ({_EASEMENT_SQL}))
        GROUP BY ALL""",
)
def conservation_union(spark: SparkSession, sf: str) -> DataFrame:
    united = conservation.conservation_union(
        _practice_payments(spark, sf), _reserve_payments(spark, sf), _easement_payments(spark, sf)
    )
    sums = united.groupBy("entity_name", "entity_type", "state_code", "year").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("amount").alias("amount"),
        F.sum("contract_count").alias("contract_count"),
        F.count("practice_code").alias("coded"),
    )
    return doubles(sums, "amount")


@QUERIES.add(
    "costs_participation",
    "L7",
    f"""WITH sums AS (SELECT n_name, year, sum(amount) AS amount, sum(quantity) AS quantity
                     FROM ({CELLS_SQL}) GROUP BY ALL)
        SELECT grid.state_code, grid.year, 'flag N' AS entity_name, 'program' AS entity_type,
               CAST(amount AS DOUBLE) AS amount, CAST(quantity AS DOUBLE) AS recipient_count
        FROM ({GRID_SQL}) grid JOIN (SELECT DISTINCT n_name FROM sums) USING (n_name)
             LEFT JOIN sums ON sums.n_name = grid.n_name AND sums.year = grid.year
        WHERE grid.year BETWEEN 1996 AND 2000""",
)
def costs_participation(spark: SparkSession, sf: str) -> DataFrame:
    codes = F.lpad(F.regexp_extract("n_name", r"(\d+)", 1), 2, "0")
    sums = cells(spark, sf).withColumn("code", codes)
    costs = wide(sums, "amount", "code", "State").withColumn("Total", F.lit(0))
    people = wide(sums, "quantity", "code", "State").withColumn("Avg.", F.lit(0))
    result = nutrition.costs_participation(
        costs, people, 1996, 2000, entity_name="flag N", names=NATION_NAMES, types=ENTITY_TYPES
    )
    return doubles(result, "amount", "recipient_count")


@QUERIES.add(
    "insurance_benefits",
    "L8",
    f"""SELECT state_code, year, 'Crop Insurance' AS entity_name, 'program' AS entity_type, premium_policy_count,
               CAST(base_acres AS DOUBLE) AS base_acres, CAST(liability_amount AS DOUBLE) AS liability_amount,
               CAST(premium_amount AS DOUBLE) AS premium_amount, CAST(indemnity_amount AS DOUBLE) AS indemnity_amount,
               CASE WHEN premium_amount <> 0
                    THEN CAST(indemnity_amount AS DOUBLE) / CAST(premium_amount AS DOUBLE) END AS loss_ratio
        FROM (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state_code, l_partkey, year,
                     count(*) AS premium_policy_count, sum(CAST(l_quantity AS DECIMAL(14,2))) AS base_acres,
                     sum(price) AS liability_amount, sum(CAST(l_tax AS DECIMAL(4,2)) * price) AS premium_amount,
                     sum(CAST(l_discount AS DECIMAL(4,2)) * price) AS indemnity_amount
              FROM ({SUPPLIER_LINES_SQL}) WHERE year BETWEEN 1996 AND 1999 GROUP BY ALL)""",
)
def insurance_benefits(spark: SparkSession, sf: str) -> DataFrame:
    sums = (
        supplier_lines(spark, sf)
        .groupBy(padded_code("s_nationkey").alias("state"), "l_partkey", "year")
        .agg(
            F.count(F.lit(1)).alias("policies_prem"),
            F.sum(F.col("l_quantity").cast("decimal(14,2)")).cast("double").alias("acres_insured"),
            F.sum("price").cast("double").alias("liabilities"),
            F.sum(F.col("l_tax").cast("decimal(4,2)") * F.col("price")).cast("double").alias("premium"),
            F.sum(F.col("l_discount").cast("decimal(4,2)") * F.col("price")).cast("double").alias("indemnity"),
        )
        .withColumn("loss_ratio", F.when(F.col("premium") != 0, F.col("indemnity") / F.col("premium")))
    )
    return insurance.insurance_benefits(sums, 1996, 1999).drop("l_partkey")


def _list_sources(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    part = table(spark, sf, "part")
    number = (F.col("p_partkey") % 700).cast("string")
    turn = F.col("p_size") % 3
    national = _lines(part.where(turn == 0), "p_name", *_in_parens(F.col("p_type")), *_in_parens(number))
    csp = _lines(
        part.where(turn == 1), "p_name", F.lit(" (C"), number, *_in_parens(F.col("p_type")), F.lit(")")
    )
    eqip = _lines(part.where(turn == 2), "p_name", *_in_parens(F.concat(F.lit("E"), number, F.lit("X"))))
    return national, csp, eqip


_LIST_CODES = """
SELECT p_partkey, p_name AS practice_name, CAST(p_partkey % 700 AS VARCHAR) AS k, p_size % 3 AS turn, p_type,
       CASE WHEN p_size % 3 = 2 THEN 'EQIP' WHEN p_size % 3 = 1 THEN 'CSP' ELSE 'NRCS' END AS source,
       CASE WHEN p_size % 3 = 2 THEN 0 WHEN p_size % 3 = 1 THEN 1 ELSE 2 END AS rank,
       CASE WHEN p_size % 3 = 0 OR p_partkey % 700 >= 100 THEN CAST(p_partkey % 700 AS VARCHAR)
            WHEN p_size % 3 = 2 THEN 'E' || CAST(p_partkey % 700 AS VARCHAR) || 'X'
            ELSE 'C' || CAST(p_partkey % 700 AS VARCHAR) || ' (' || p_type || ')' END AS practice_code
FROM part
"""


@QUERIES.add(
    "practice_lists",
    "L9",
    f"""SELECT practice_code, practice_name, source FROM (
            SELECT * FROM ({_LIST_CODES})
            QUALIFY row_number() OVER (PARTITION BY practice_code ORDER BY rank, p_partkey) = 1)
        UNION ALL VALUES ('OTP', 'Other Payment', 'CSP'), ('EUP', 'Erroneous Underpayment', 'CSP'),
                         ('ERP', 'Equitable Relief Payment', 'CSP')""",
)
def practice_lists(spark: SparkSession, sf: str) -> DataFrame:
    return practices.practice_lists(*_list_sources(spark, sf)).merged


@QUERIES.add(
    "practice_list_files",
    "L9",
    f"""SELECT 'merged' AS list, practice_code, practice_name, source AS detail,
               row_number() OVER (ORDER BY practice_code, practice_name, source) AS position
        FROM (SELECT practice_code, practice_name, source FROM (
                  SELECT * FROM ({_LIST_CODES})
                  QUALIFY row_number() OVER (PARTITION BY practice_code ORDER BY rank, p_partkey) = 1)
              UNION ALL VALUES ('OTP', 'Other Payment', 'CSP'), ('EUP', 'Erroneous Underpayment', 'CSP'),
                               ('ERP', 'Equitable Relief Payment', 'CSP'))
        UNION ALL
        SELECT 'national', k, practice_name, p_type, row_number() OVER (ORDER BY k, practice_name, p_type)
        FROM ({_LIST_CODES}) WHERE turn = 0""",
)
def practice_list_files(spark: SparkSession, sf: str) -> DataFrame:
    """Two of the four files, read back with the place of each line."""
    found = practices.practice_lists(*_list_sources(spark, sf))
    paths = practices.store_practice_lists(found, scratch_path(spark, "practice-lists"))
    frames = []
    for name, detail in (("merged", "source"), ("national", "practice_unit")):
        rows = with_position(read_csv(spark, paths[name], order="ord"), "ord")
        columns = [F.lit(name).alias("list"), "practice_code", "practice_name", F.col(detail).alias("detail"), "position"]
        frames.append(rows.select(*columns))
    return union_all(*frames)


@QUERIES.add(
    "seed_practices_last_wins",
    "L10",
    """SELECT p_name AS code, max_by(p_brand, p_partkey) AS name FROM part GROUP BY p_name""",
)
def seed_practices_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    """A list with many lines per code: the last line of the file counts."""
    lines = table(spark, sf, "part").select(
        F.col("p_partkey").alias("ord"), F.col("p_name").alias("practice_code"), F.col("p_brand").alias("practice_name"), F.lit("X").alias("source")
    )
    return dimensions.seed_practices(lines).select("code", "name")


@QUERIES.add(
    "practice_matches",
    "L9",
    """WITH national AS (SELECT p_partkey, CAST(p_partkey % 700 AS VARCHAR) AS code FROM part WHERE p_size % 3 = 0),
            listed AS (SELECT code, min(p_partkey) AS ord FROM national GROUP BY code),
            program AS (SELECT DISTINCT 'E' || CAST(p_partkey % 700 AS VARCHAR) || 'X' AS practice_code
                        FROM part WHERE p_size % 3 = 2),
            best AS (SELECT practice_code, code FROM program JOIN listed ON contains(practice_code, code)
                     QUALIFY row_number() OVER (PARTITION BY practice_code ORDER BY ord) = 1)
       SELECT 'E' || CAST(p_partkey % 700 AS VARCHAR) || 'X' AS practice_code, p_name AS practice_name,
              code AS matched_code
       FROM part LEFT JOIN best ON practice_code = 'E' || CAST(p_partkey % 700 AS VARCHAR) || 'X'
       WHERE p_size % 3 = 2""",
)
def practice_matches(spark: SparkSession, sf: str) -> DataFrame:
    return practices.practice_lists(*_list_sources(spark, sf)).eqip_matches


@QUERIES.add(
    "seed_dims",
    "L10",
    """SELECT 'title' AS level, CAST(row_number() OVER (ORDER BY r_regionkey) + 99 AS INT) AS id, r_name AS name,
              NULL::INT AS title_id, NULL::INT AS subtitle_id FROM region
       UNION ALL
       SELECT 'subtitle', CAST(row_number() OVER (ORDER BY n_nationkey) + 99 AS INT), n_name,
              CAST(n_regionkey + 100 AS INT), NULL FROM nation
       UNION ALL
       SELECT 'program', CAST(row_number() OVER (ORDER BY s_suppkey) + 99 AS INT), s_name,
              CAST(n_regionkey + 100 AS INT), CAST(n_nationkey + 100 AS INT)
       FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def seed_dims(spark: SparkSession, sf: str) -> DataFrame:
    region, nation = table(spark, sf, "region"), table(spark, sf, "nation")
    tree = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    suppliers = table(spark, sf, "supplier").join(tree, F.col("s_nationkey") == F.col("n_nationkey"))
    title_rows = region.select(F.col("r_regionkey").alias("ord"), F.col("r_name").alias("name"))
    subtitle_rows = tree.select(F.col("n_nationkey").alias("ord"), F.col("n_name").alias("name"), F.col("r_name").alias("title"))
    program_rows = suppliers.select(
        F.col("s_suppkey").alias("ord"),
        F.col("s_name").alias("name"),
        F.col("r_name").alias("title"),
        F.col("n_name").alias("subtitle"),
    )
    titles = dimensions.add_members(None, title_rows, ["name"])
    subtitles = dimensions.add_members(
        None, dimensions.find_parent(subtitle_rows, titles, "title", "title_id"), ["name", "title_id"]
    )
    placed = dimensions.find_parent(program_rows, titles, "title", "title_id")
    programs = dimensions.add_members(
        None, dimensions.find_parent(placed, subtitles, "subtitle", "subtitle_id", "left"), ["name", "title_id"]
    )
    levels = {"title": titles, "subtitle": subtitles, "program": programs}
    absent = F.lit(None).cast("int")
    return union_all(
        *[
            frame.select(
                F.lit(level).alias("level"),
                "id",
                "name",
                *[F.col(c) if c in frame.columns else absent.alias(c) for c in ("title_id", "subtitle_id")],
            )
            for level, frame in levels.items()
        ]
    )


_LOAD_SQL = f"""
WITH {DIMENSIONS_SQL},
source AS (
    SELECT l_orderkey, l_linenumber, l_returnflag, entity_type, entity_name, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state_code,
           CAST(year(l_shipdate) AS INT) AS year, CAST(l_extendedprice AS DECIMAL(14,2)) * 1.005 AS amount,
           CAST(l_quantity + 0.5 AS DECIMAL(14,2)) AS recipient_count,
           CASE WHEN entity_type = 'program' THEN 'E' || CAST(l_partkey % 700 AS VARCHAR) || 'X' END AS variant,
           CASE WHEN entity_type = 'program' AND l_linestatus = 'F' AND l_suppkey < 3 THEN p_type END AS category,
           l_partkey % 700 AS k, n_nationkey
    FROM ({MIXED_SQL}) JOIN part ON l_partkey = p_partkey),
judged AS (
    SELECT source.*, e.title_id, e.subtitle_id, e.program_id, e.sub_program_id, e.sub_sub_program_id,
           c.id AS practice_category_id, CASE WHEN variant IS NULL THEN NULL WHEN k >= 100 THEN CAST(k AS VARCHAR)
           ELSE variant END AS practice_code,
           CASE WHEN entity_type = 'county' THEN 'unknown entity type'
                WHEN e.entity_name IS NULL THEN 'unknown entity name'
                WHEN category IS NOT NULL AND c.id IS NULL THEN 'unknown practice category'
                WHEN n_nationkey = 24 THEN 'unknown state code'
                WHEN variant IS NOT NULL AND k NOT IN (SELECT p_partkey % 700 FROM part WHERE p_partkey % 700 < 600)
                THEN 'unknown practice code' END AS reason
    FROM source LEFT JOIN entities e USING (entity_type, entity_name)
         LEFT JOIN practice_categories c ON c.name = category AND c.program_id = e.program_id)
"""


def _load_rows(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    kinds = table(spark, sf, "part").select("p_partkey", "p_type")
    # Parts first: a shuffle for them moves numbers, and no names yet.
    parted = table(spark, sf, "lineitem").join(kinds, F.col("l_partkey") == F.col("p_partkey"))
    lines = mixed_entities(supplier_lines(spark, sf, parted))
    category = F.when((F.col("l_linestatus") == "F") & (F.col("l_suppkey") < 3), F.col("p_type"))
    return lines.select(
        *extra,
        "entity_type",
        "entity_name",
        padded_code("s_nationkey").alias("state_code"),
        "year",
        (money("l_extendedprice") * F.lit("1.005").cast("decimal(4,3)")).alias("amount"),
        (F.col("l_quantity") + 0.5).alias("recipient_count"),
        F.concat(F.lit("E"), (F.col("l_partkey") % 700).cast("string"), F.lit("X")).alias("practice_code"),
        category.alias("practice_category"),
    )


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    return facts.judge_payments(_load_rows(spark, sf), proxy_dimensions(spark, sf))


@QUERIES.add(
    "load_facts",
    "L11",
    f"""{_LOAD_SQL}
        SELECT CAST(title_id AS INT) AS title_id, CAST(subtitle_id AS INT) AS subtitle_id,
               CAST(program_id AS INT) AS program_id, CAST(sub_program_id AS INT) AS sub_program_id,
               CAST(sub_sub_program_id AS INT) AS sub_sub_program_id,
               CAST(practice_category_id AS INT) AS practice_category_id, state_code, year,
               CAST(round(amount, 2) AS DOUBLE) AS payment, CAST(round(recipient_count, 0) AS BIGINT) AS recipient_count,
               practice_code, variant AS practice_code_variant
        FROM judged WHERE reason IS NULL""",
)
def load_facts(spark: SparkSession, sf: str) -> DataFrame:
    stored_columns = [
        "title_id",
        "subtitle_id",
        "program_id",
        "sub_program_id",
        "sub_sub_program_id",
        "practice_category_id",
        "state_code",
        "year",
        "payment",
        "recipient_count",
        "practice_code",
        "practice_code_variant",
    ]
    # Judged once, as a load does.
    return doubles(facts.accepted(stored(_judged(spark, sf), "judged")).select(stored_columns), "payment")


# Stored rows of which some are spoiled, so that every rule is broken by some rows and by no others.
SPOILED = {
    "id": "CASE WHEN year = 1996 THEN NULL ELSE 100 * year + coalesce(program_id, 0) % 7 END",
    "title_id": "CASE WHEN year = 1993 THEN -title_id ELSE title_id END",
    "subtitle_id": "CASE WHEN year = 1994 AND subtitle_id % 2 = 0 THEN 1 ELSE subtitle_id END",
    "program_id": "CASE WHEN state_code = '03' THEN 0 ELSE program_id END",
    "sub_program_id": "CASE WHEN state_code = '04' THEN 0 ELSE sub_program_id END",
    "sub_sub_program_id": "CASE WHEN state_code = '05' THEN 0 ELSE sub_sub_program_id END",
    "practice_category_id": "CASE WHEN state_code = '06' THEN 0 ELSE practice_category_id END",
    "state_code": "CASE WHEN state_code = '07' THEN NULL WHEN state_code = '08' THEN '008' ELSE state_code END",
    "year": "CASE WHEN state_code = '09' THEN NULL ELSE year END",
    "practice_code": "CASE WHEN state_code = '10' THEN 'x' || practice_code WHEN state_code = '11' THEN repeat(practice_code, 101) ELSE practice_code END",
    "practice_code_variant": "CASE WHEN state_code = '12' THEN repeat(practice_code_variant, 101) ELSE practice_code_variant END",
}


def _one_pass_sql() -> str:
    kept = [f"{expression} AS {name}" for name, expression in SPOILED.items()]
    unique = ", ".join(schemas.PAYMENT_UNIQUE)
    present = " AND ".join(f"{name} IS NOT NULL" for name in schemas.PAYMENT_UNIQUE)
    keys = {
        "state_code": "SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') FROM nation WHERE n_nationkey < 24",
        "practice_code": """SELECT CASE WHEN k >= 100 THEN CAST(k AS VARCHAR) ELSE 'E' || k || 'X' END
                            FROM (SELECT p_partkey % 700 AS k FROM part WHERE p_partkey % 700 < 600)""",
    }
    rules = [
        "SELECT 'primary key' AS rule, count(*) AS broken FROM (SELECT id FROM spoiled GROUP BY id HAVING id IS NULL OR count(*) > 1)",
        f"SELECT 'unique node, state and year', count(*) FROM (SELECT {unique} FROM spoiled WHERE {present} GROUP BY {unique} HAVING count(*) > 1)",
        "SELECT 'state and year present', count(*) FROM spoiled WHERE state_code IS NULL OR year IS NULL",
    ]
    for column, (dimension, key) in schemas.PAYMENT_REFERENCES.items():
        known = keys.get(column, f"SELECT {key} FROM {dimension}")
        rules.append(f"SELECT '{column} known', count(*) FROM spoiled WHERE {column} IS NOT NULL AND {column} NOT IN ({known})")
    for column, longest in schemas.PAYMENT_LENGTHS.items():
        rules.append(f"SELECT '{column} length', count(*) FROM spoiled WHERE length({column}) > {longest}")
    return f"""{_LOAD_SQL}, stored AS (SELECT *, variant AS practice_code_variant FROM judged WHERE reason IS NULL),
        spoiled AS (SELECT {', '.join(kept)} FROM stored)
        SELECT * FROM ({' UNION ALL '.join(rules)}) WHERE broken > 0"""


@QUERIES.add("load_check_one_pass", "L11", _one_pass_sql())
def load_check_one_pass(spark: SparkSession, sf: str) -> DataFrame:
    """All constraints of a load in one scan of its facts."""
    dims = proxy_dimensions(spark, sf)
    rows = facts.accepted(stored(facts.judge_payments(_load_rows(spark, sf), dims), "judged"))
    kinds = {field.name: field.dataType.simpleString() for field in schemas.PAYMENTS.fields}
    spoiled = rows.select(*[F.expr(SPOILED.get(name, name)).cast(kind).alias(name) for name, kind in kinds.items()])
    return facts.broken_rules(spoiled, dims)


@QUERIES.add("load_rejects", "L11", f"{_LOAD_SQL} SELECT reason, count(*) AS row_count FROM judged WHERE reason IS NOT NULL GROUP BY reason")
def load_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return facts.rejected(_judged(spark, sf)).groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))


def _load_by_flag(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Line items as one source per return flag, each loaded in a call of its own and the first one twice."""
    dims = proxy_dimensions(spark, sf)
    entities = stored(entity_dimension(dims), "entities")
    # The files of the sources: derived once, as they would lie there.
    rows = stored(_load_rows(spark, sf, "l_returnflag"), "source-rows")
    base = scratch_path(spark, "load")
    for flag in [*FLAGS, FLAGS[0]]:
        own = rows.where(F.col("l_returnflag") == flag).drop("l_returnflag")
        # Early years are what a cleaning step would leave out.
        early = own.where("year < 1996").select("state_code", "year", F.lit("year out of range").alias("reason"))
        load_source(flag, Source(own.where("year >= 1996"), early), dims, entities, f"{base}/facts", f"{base}/rejects")
    return open_facts(spark, f"{base}/facts"), open_rejects(spark, f"{base}/facts", f"{base}/rejects")


@QUERIES.add(
    "load_in_steps",
    "L11",
    f"""{_LOAD_SQL} SELECT l_returnflag AS source, count(*) AS row_count, count(*) AS id_count,
                           CAST(sum(round(amount, 2)) AS DOUBLE) AS payment
        FROM judged WHERE reason IS NULL AND year >= 1996 GROUP BY l_returnflag""",
)
def load_in_steps(spark: SparkSession, sf: str) -> DataFrame:
    loaded, _ = _load_by_flag(spark, sf)
    sums = loaded.groupBy("source").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("id").alias("id_count"), F.sum("payment").alias("payment")
    )
    return doubles(sums, "payment")


@QUERIES.add(
    "load_all_rejects",
    "L11",
    f"""{_LOAD_SQL} SELECT l_returnflag AS source, CASE WHEN year < 1996 THEN 'year out of range' ELSE reason END AS reason,
                           CASE WHEN year < 1996 THEN 'cleaning' ELSE 'load' END AS step, count(*) AS row_count
        FROM judged WHERE reason IS NOT NULL OR year < 1996 GROUP BY ALL""",
)
def load_all_rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, rejects = _load_by_flag(spark, sf)
    return rejects.groupBy("source", "reason", "step").agg(F.count(F.lit(1)).alias("row_count"))
