"""Sources, sinks, column cleaning and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake import schemas
from spendlake.functions import scalars as S
from spendlake.operators import columns as C
from spendlake.operators import filters
from spendlake.operators.combine import union_all
from spendlake.operators.ordering import with_position
from spendlake.queries import Registry
from spendlake.queries.proxies import (
    CELLS_SQL,
    YEARS,
    cells,
    doubles,
    money,
    payments,
    payments_sql,
    table,
    wide,
)
from spendlake.session import scratch_path
from spendlake.sources.files import csv_rejects, read_csv, read_lines, write_sorted_csv
from spendlake.sources.literals import literal_relation
from spendlake.sources.tables import append_facts, insert_if_absent, lay_out, open_buckets, upsert, upsert_into

QUERIES = Registry()


@QUERIES.add("src_csv", "S1", "SELECT * FROM part")
def src_csv(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    path = scratch_path(spark, "part-csv")
    part.write.option("header", True).csv(path)
    return read_csv(spark, path, part.schema)


# Line breaks of both kinds, quotes, commas, blank lines and empty texts inside of fields.
BROKEN_LINES = """CASE p_partkey % 6
    WHEN 0 THEN concat(p_name, {nl}, p_type)
    WHEN 1 THEN concat('"', p_name, '",', {nl}, {nl}, '""', {nl}, p_brand, ',')
    WHEN 2 THEN concat({cr}, {nl}, p_name, {cr}, {nl}, p_partkey, ',x')
    WHEN 3 THEN concat({nl}, ',"', p_brand)
    ELSE p_type END"""


@QUERIES.add(
    "src_csv_multiline",
    "S1",
    f"SELECT p_partkey, {BROKEN_LINES.format(nl='chr(10)', cr='chr(13)')} AS label, p_size FROM part",
)
def src_csv_multiline(spark: SparkSession, sf: str) -> DataFrame:
    """Fields that go over several lines, in files read in splits."""
    part = table(spark, sf, "part")
    label = F.expr(BROKEN_LINES.format(nl="char(10)", cr="char(13)"))
    rows = part.select("p_partkey", label.alias("label"), "p_size")
    path = scratch_path(spark, "multiline-csv")
    # The writer doubles quotes, as the reader expects them, and keeps blanks and breaks at either end.
    options = {"header": True, "escape": '"', "quoteAll": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(**options).csv(path)
    return read_csv(spark, path, rows.schema)


# Files of the next query; more rows make larger files, read in splits.
BAD_FILES = 8


@QUERIES.add(
    "src_csv_bad_rows",
    "S1",
    """SELECT p_partkey, CASE WHEN p_size % 7 <> 0 THEN p_name || ', "' || p_type || '"' END AS label, NULL AS reason
       FROM part WHERE p_size % 5 <> 0
       UNION ALL
       SELECT NULL, CAST(p_partkey AS VARCHAR) || ',x,y', 'more fields than headers' FROM part WHERE p_size % 5 = 0""",
)
def src_csv_bad_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Quotes in quotes, rows with a field too few, and rows with one too many, in several files."""
    quoted = F.concat(F.lit('"'), "p_name", F.lit(', ""'), "p_type", F.lit('"""'))
    line = F.when(F.col("p_size") % 5 == 0, F.concat_ws(",", "p_partkey", F.lit("x"), F.lit("y")))
    line = line.when(F.col("p_size") % 7 == 0, F.col("p_partkey").cast("string")).otherwise(F.concat_ws(",", "p_partkey", quoted))
    part = table(spark, sf, "part").withColumn("file", F.pmod(F.hash("p_partkey"), F.lit(BAD_FILES)))
    rows = part.select("file", F.col("p_partkey").cast("long").alias("place"), line.alias("value"))
    # A header on top of every file; the files are dealt to tasks, and the lines of each are in order.
    head = spark.range(BAD_FILES).select(F.col("id").cast("int").alias("file"), F.lit(-1).cast("long").alias("place"), F.lit("p_partkey,label").alias("value"))
    folder = scratch_path(spark, "bad-csv")
    sorted_rows = head.unionByName(rows).repartition("file").sortWithinPartitions("file", "place")
    sorted_rows.select("file", "value").write.partitionBy("file").text(folder)
    paths = f"{folder}/file=*"
    kind = table(spark, sf, "part").schema["p_partkey"].dataType
    schema = T.StructType([T.StructField("p_partkey", kind), T.StructField("label", T.StringType())])
    kept = read_csv(spark, paths, schema, skip_surplus=True).withColumn("reason", F.lit(None).cast("string"))
    left = csv_rejects(spark, paths).select(F.lit(None).cast(kind).alias("p_partkey"), F.col("line").alias("label"), "reason")
    return kept.unionByName(left)


@QUERIES.add(
    "src_lines",
    "S2",
    """SELECT p_name || ' (' || p_type || ') (' || p_brand || ')' AS line, count(*) AS row_count
       FROM part GROUP BY 1""",
)
def src_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "part-lines")
    lines = F.concat("p_name", F.lit(" ("), "p_type", F.lit(") ("), "p_brand", F.lit(")"))
    table(spark, sf, "part").select(lines.alias("value")).write.text(path)
    read = read_lines(spark, path).where("line <> ''")
    return read.groupBy("line").agg(F.count(F.lit(1)).alias("row_count"))


@QUERIES.add(
    "src_literals",
    "S3",
    """SELECT label, count(*) AS customers
       FROM (VALUES (0, 'south'), (1, 'west'), (9, 'nowhere')) AS named(r_key, label)
            JOIN nation ON n_regionkey = r_key JOIN customer ON c_nationkey = n_nationkey
       GROUP BY label""",
)
def src_literals(spark: SparkSession, sf: str) -> DataFrame:
    schema = T.StructType([T.StructField("n_regionkey", T.IntegerType()), T.StructField("label", T.StringType())])
    named = literal_relation(spark, [(0, "south"), (1, "west"), (9, "nowhere")], schema)
    nations = table(spark, sf, "nation").join(named, "n_regionkey").select("n_nationkey", "label")
    customers = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("rows"))
    joined = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("label").agg(F.sum("rows").alias("customers"))


@QUERIES.add(
    "sink_sorted_csv",
    "S4",
    """SELECT s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey,
              row_number() OVER (ORDER BY s_nationkey, s_name) AS position FROM supplier""",
)
def sink_sorted_csv(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "supplier").select("s_name", "s_nationkey")
    path = write_sorted_csv(rows, ["s_nationkey", "s_name"], scratch_path(spark, "supplier-csv"))
    read = (
        spark.read.option("header", True)
        .csv(path)
        .select(
            "s_name",
            "s_nationkey",
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        )
    )
    return with_position(read, "file", "block", "line").drop("file", "block", "line")


@QUERIES.add(
    "sink_append_facts",
    "S5",
    f"""SELECT year, count(*) AS row_count, CAST(sum(payment) AS DOUBLE) AS payment
        FROM ({payments_sql(hierarchy=True)}) GROUP BY year""",
)
def sink_append_facts(spark: SparkSession, sf: str) -> DataFrame:
    facts = payments(spark, sf, hierarchy=True)
    path = scratch_path(spark, "facts")
    append_facts(facts.where("year % 2 = 1"), path)
    append_facts(facts.where("year % 2 = 0"), path)
    sums = spark.read.parquet(path).groupBy("year")
    return doubles(sums.agg(F.count(F.lit(1)).alias("row_count"), F.sum("payment").alias("payment")), "payment")


@QUERIES.add(
    "sink_upsert",
    "S6",
    """SELECT p_partkey, p_name, CAST(CAST(p_retailprice AS DECIMAL(14,2))
              * CASE WHEN p_partkey % 10 = 0 THEN 2 ELSE 1 END AS DOUBLE) AS price FROM part""",
)
def sink_upsert(spark: SparkSession, sf: str) -> DataFrame:
    base = table(spark, sf, "part").select("p_partkey", "p_name", money("p_retailprice").alias("price"))
    changed = base.where("p_partkey % 10 = 0")
    writes = union_all(
        *[
            changed.withColumns({"price": (F.col("price") * factor).cast("decimal(14,2)"), "ord": F.lit(place)})
            for place, factor in enumerate((3, 2))
        ]
    )
    return doubles(upsert(base, writes, ["p_partkey"], ["ord"]), "price")


@QUERIES.add(
    "sink_upsert_touched",
    "S6",
    """SELECT p_partkey, p_name, CAST(CAST(p_retailprice AS DECIMAL(14,2))
              * CASE WHEN p_partkey % 1000 = 0 THEN 3 ELSE 1 END AS DOUBLE) AS price FROM part
       UNION ALL SELECT -p_partkey - 1, 'new', 1 FROM part WHERE p_partkey % 1000 = 0""",
)
def sink_upsert_touched(spark: SparkSession, sf: str) -> DataFrame:
    """A stored table changed in place: two batches, the second of which wins."""
    base = table(spark, sf, "part").select("p_partkey", "p_name", money("p_retailprice").alias("price"))
    path = lay_out(base, scratch_path(spark, "buckets"), ["p_partkey"], buckets=32)
    some = base.where("p_partkey % 1000 = 0")
    for factor in (2, 3):
        changed = some.withColumn("price", (F.col("price") * factor).cast("decimal(14,2)"))
        added = some.select((-F.col("p_partkey") - 1).alias("p_partkey"), F.lit("new").alias("p_name"), F.lit(factor - 2).cast("decimal(14,2)").alias("price"))
        batch = changed.unionByName(added).withColumn("ord", F.lit(factor))
        upsert_into(spark, path, base.schema, batch, ["p_partkey"], ["ord"])
    return doubles(open_buckets(spark, path, base.schema), "price")


@QUERIES.add(
    "sink_insert_if_absent",
    "S7",
    """SELECT s_suppkey AS key, s_name AS name FROM supplier
       UNION ALL
       SELECT c_custkey, c_name FROM customer
       WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey)""",
)
def sink_insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    base = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    new = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    return insert_if_absent(base, new, ["key"], ["name"])


_NULL_TYPES = {"integer": "INTEGER", "long": "BIGINT", "decimal": "DOUBLE", "string": "VARCHAR"}
_FILLED = {
    "title_id": "CAST(title_id AS INTEGER)",
    "subtitle_id": "CAST(subtitle_id AS INTEGER)",
    "program_id": "CAST(program_id AS INTEGER)",
    "state_code": "state_code",
    "year": "year",
    "payment": "CAST(payment AS DOUBLE)",
    "practice_code": "code",
}
_PAYMENT_COLUMNS = ", ".join(
    f"{_FILLED.get(f.name, 'CAST(NULL AS ' + _NULL_TYPES[f.dataType.typeName()] + ')')} AS {f.name}"
    for f in schemas.PAYMENTS.fields
)


@QUERIES.add(
    "schema_payments",
    "S8",
    f"SELECT {_PAYMENT_COLUMNS} FROM ({payments_sql(hierarchy=True, state=True, part=True)})",
)
def schema_payments(spark: SparkSession, sf: str) -> DataFrame:
    facts = payments(spark, sf, hierarchy=True, state=True, part=True).withColumnRenamed("code", "practice_code")
    projected = C.project_to_schema(facts, schemas.PAYMENTS)
    return doubles(projected, "payment", "base_acres", "loss_ratio")


@QUERIES.add("hdr_trim", "P1", "SELECT * FROM customer")
def hdr_trim(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    return C.trim_headers(customer.toDF(*[f"  {name} " for name in customer.columns]))


@QUERIES.add("hdr_rename", "P2", "SELECT p_partkey, p_type AS p_brand, p_brand AS brand_raw FROM part")
def hdr_rename(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_brand")
    return C.rename_synonyms(part, {"p_type": "p_brand", "p_brand": "brand_raw"})


@QUERIES.add("val_trim", "P3", "SELECT c_custkey, c_name FROM customer")
def val_trim(spark: SparkSession, sf: str) -> DataFrame:
    padded = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit(" \t"), "c_name", F.lit("  ")).alias("c_name")
    )
    return C.trim_columns(padded, ["c_name", "no_such_column"])


@QUERIES.add("col_subset", "P4", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def col_subset(spark: SparkSession, sf: str) -> DataFrame:
    return C.select_columns(table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_quantity"])


@QUERIES.add(
    "col_years",
    "P5",
    "SELECT n_name AS state_name, "
    + ", ".join(
        f'CAST(sum(amount) FILTER (year = {year}) AS DOUBLE) AS "{year}"' for year in (1996, 1997, 1998)
    )
    + f" FROM ({CELLS_SQL}) GROUP BY n_name",
)
def col_years(spark: SparkSession, sf: str) -> DataFrame:
    table_by_year = wide(cells(spark, sf), "amount", name="state_name").withColumn("Total", F.lit(None).cast("double"))
    chosen = C.select_year_columns(table_by_year, "state_name", 1996, 1998, skip=["Total"])
    return chosen.select("state_name", *[S.named(str(y)).cast("double").alias(str(y)) for y in YEARS if 1996 <= y <= 1998])


@QUERIES.add(
    "tag_entity",
    "P6",
    "SELECT s_suppkey, 'Crop Insurance' AS entity_name, 'program' AS entity_type FROM supplier",
)
def tag_entity(spark: SparkSession, sf: str) -> DataFrame:
    return C.tag_entity(table(spark, sf, "supplier").select("s_suppkey"), "Crop Insurance", "program")


@QUERIES.add(
    "scale_1000",
    "P7",
    "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(20,8)) * 1000 AS DOUBLE) AS amount FROM orders",
)
def scale_1000(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("amount"))
    return doubles(C.scale(orders, "amount", 1000), "amount")


@QUERIES.add("coerce_number", "P8", "SELECT l_orderkey, l_linenumber, NULLIF(l_tax, 0) AS tax FROM lineitem")
def coerce_number(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("l_tax") == 0, " ").otherwise(F.col("l_tax").cast("string"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.alias("tax"))
    return C.to_numeric(lines, ["tax"], T.DoubleType())


@QUERIES.add(
    "round_2",
    "P9",
    """SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice AS DECIMAL(14,2))
              * CAST(l_discount AS DECIMAL(4,2)), 2) AS DOUBLE) AS saved FROM lineitem""",
)
def round_2(spark: SparkSession, sf: str) -> DataFrame:
    saved = S.round2(money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", saved.cast("double").alias("saved"))


@QUERIES.add(
    "title_case",
    "P10",
    """SELECT c_custkey, upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS c_mktsegment
       FROM customer""",
)
def title_case(spark: SparkSession, sf: str) -> DataFrame:
    return C.title_case(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment")


@QUERIES.add(
    "recode_col",
    "P11",
    """SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'Small' WHEN 'LARGE' THEN 'Big' WHEN 'PROMO' THEN 'SMALL'
              ELSE p_type END AS p_type FROM part""",
)
def recode_col(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_type")
    return C.recode(part, "p_type", {"SMALL": "Small", "LARGE": "Big", "PROMO": "SMALL"})


_RECODES = {"SMALL": "tiny", "small ring": "tiny", "Brand#2": "Brand two"}


def _recoded(column: str) -> str:
    cases = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in _RECODES.items())
    return f"CASE {column} {cases} ELSE {column} END AS {column}"


@QUERIES.add(
    "recode_all",
    "P12",
    f"SELECT p_partkey, {_recoded('p_name')}, {_recoded('p_brand')}, {_recoded('p_type')}, p_size FROM part",
)
def recode_all(spark: SparkSession, sf: str) -> DataFrame:
    return C.recode_all(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"), _RECODES)


_SOME_NATIONS = {key: f"NATION_{key}" for key in range(20)}


@QUERIES.add(
    "map_code_to_name",
    "P13",
    """SELECT c_custkey, n_name FROM customer
       LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 20""",
)
def map_code_to_name(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_name"))
    return C.map_forward(customer, "n_name", _SOME_NATIONS)


@QUERIES.add(
    "map_name_to_code",
    "P14",
    """SELECT c_custkey, CASE WHEN n_nationkey < 20 THEN n_nationkey END AS code
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def map_name_to_code(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    named = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return C.map_reverse(named.select("c_custkey", "n_name"), "n_name", _SOME_NATIONS, "code").drop("n_name")


@QUERIES.add(
    "classify_entity",
    "P15",
    """SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'program' WHEN p_type = 'LARGE' THEN 'subtitle'
              ELSE 'unknown' END AS entity_type FROM part""",
)
def classify_entity(spark: SparkSession, sf: str) -> DataFrame:
    kind = S.classify(F.col("p_type"), {"program": ["SMALL", "MEDIUM"], "subtitle": ["LARGE"]})
    return table(spark, sf, "part").select("p_partkey", kind.alias("entity_type"))


@QUERIES.add(
    "code_digits",
    "P16",
    r"""SELECT p_partkey, code AS practice_code_variant,
               CASE WHEN regexp_matches(code, '\d{3}') THEN regexp_extract(code, '(\d{3})', 1) ELSE code END
               AS practice_code
        FROM (SELECT p_partkey, 'E' || CAST(p_partkey % 700 AS VARCHAR) || 'X' AS code FROM part)""",
)
def code_digits(spark: SparkSession, sf: str) -> DataFrame:
    code = F.concat(F.lit("E"), (F.col("p_partkey") % 700).cast("string"), F.lit("X"))
    return table(spark, sf, "part").select(
        "p_partkey", code.alias("practice_code_variant"), S.normalise_code(code).alias("practice_code")
    )


@QUERIES.add(
    "optional_cols",
    "P17",
    """SELECT o_orderkey, CASE WHEN o_totalprice >= 1000 THEN o_totalprice END AS o_totalprice,
              CAST(NULL AS BIGINT) AS farm_count, CAST(NULL AS VARCHAR) AS note FROM orders""",
)
def optional_cols(spark: SparkSession, sf: str) -> DataFrame:
    price = F.when(F.col("o_totalprice") < 1000, F.lit("NaN").cast("double")).otherwise(F.col("o_totalprice"))
    orders = table(spark, sf, "orders").select("o_orderkey", price.alias("o_totalprice"), "o_orderstatus")
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("farm_count", T.LongType()),
            T.StructField("note", T.StringType()),
        ]
    )
    return C.project_to_schema(orders, schema)


@QUERIES.add(
    "display_name",
    "P18",
    """SELECT p_partkey, p_name || ' (' || CASE WHEN p_size <> 1 THEN p_brand END || ')' AS display_name FROM part""",
)
def display_name(spark: SparkSession, sf: str) -> DataFrame:
    code = F.when(F.col("p_size") != 1, F.col("p_brand"))
    return table(spark, sf, "part").select("p_partkey", S.display_name(F.col("p_name"), code).alias("display_name"))


@QUERIES.add(
    "to_storage",
    "P19",
    """SELECT l_orderkey, l_linenumber,
              CAST(round(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(1.005 AS DECIMAL(4,3)), 2) AS DOUBLE) AS payment,
              CAST(round(CAST(l_quantity AS DECIMAL(14,2)) + CAST(0.5 AS DECIMAL(2,1)), 0) AS BIGINT) AS recipient_count
       FROM lineitem""",
)
def to_storage(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (money("l_extendedprice") * F.lit("1.005").cast("decimal(4,3)")).alias("payment"),
        (F.col("l_quantity") + 0.5).alias("recipient_count"),
    )
    return doubles(C.to_storage(lines, schemas.PAYMENTS), "payment")


@QUERIES.add(
    "flt_years",
    "F1",
    f"""SELECT l_orderkey, l_linenumber, year, CAST(payment AS DOUBLE) AS payment
        FROM ({payments_sql()}) WHERE year BETWEEN 1996 AND 1998""",
)
def flt_years(spark: SparkSession, sf: str) -> DataFrame:
    return doubles(filters.years(payments(spark, sf, years=(1996, 1998)), 1996, 1998), "payment")


@QUERIES.add(
    "flt_required",
    "F2",
    "SELECT l_orderkey, l_linenumber, l_discount AS discount FROM lineitem WHERE l_discount <> 0 AND l_tax <> 0",
)
def flt_required(spark: SparkSession, sf: str) -> DataFrame:
    discount = F.when(F.col("l_tax") == 0, F.lit("NaN").cast("double")).when(
        F.col("l_discount") != 0, F.col("l_discount")
    )
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", discount.alias("discount"))
    return filters.require(lines, "discount")


@QUERIES.add(
    "flt_membership",
    "F3",
    """SELECT p_partkey, CASE WHEN p_size <> 1 AND p_type IN ('SMALL', 'LARGE') THEN 'in' ELSE 'out' END AS side
       FROM part""",
)
def flt_membership(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("p_size") != 1, F.col("p_type"))
    part = table(spark, sf, "part").select("p_partkey", kind.alias("kind"))
    sides = [
        filters.keep_in(part, "kind", ["SMALL", "LARGE"]).withColumn("side", F.lit("in")),
        filters.keep_not_in(part, "kind", ["SMALL", "LARGE"]).withColumn("side", F.lit("out")),
    ]
    return union_all(*sides).select("p_partkey", "side")


@QUERIES.add(
    "flt_exactly_once",
    "F4",
    """SELECT o_custkey, order_year, min(o_orderkey) AS o_orderkey, min(o_totalprice) AS o_totalprice
       FROM (SELECT *, CAST(year(o_orderdate) AS INT) AS order_year FROM orders)
       GROUP BY o_custkey, order_year HAVING count(*) = 1""",
)
def flt_exactly_once(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("order_year"), "o_orderkey", "o_totalprice"
    )
    return filters.exactly_once(orders, ["o_custkey", "order_year"])


@QUERIES.add(
    "flt_node",
    "F5",
    f"""SELECT l_orderkey, l_linenumber, CAST(program_id AS BIGINT) AS program_id, CAST(payment AS DOUBLE) AS payment
        FROM ({payments_sql(hierarchy=True)}) WHERE subtitle_id = 107""",
)
def flt_node(spark: SparkSession, sf: str) -> DataFrame:
    rows = filters.for_node(payments(spark, sf, hierarchy=True), "subtitle", 107)
    return doubles(rows, "payment").select("l_orderkey", "l_linenumber", "program_id", "payment")
