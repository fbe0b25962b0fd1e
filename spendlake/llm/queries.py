"""One query per operator over the whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.llm import decontaminate, html_extract, language_id, lexical_search, lm, mixing, near_dedup, pii, quality, secret_scan, sharding, spelling, url_filter
from spendlake.llm.text import table
from spendlake.queries import Registry

QUERIES = Registry()

# ASCII lower case, as both engines spell it.
LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def fold(doc_id: Column) -> Column:
    """The remainder by five of the checksum of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


OP1_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array({LOW.format("coalesce(text, '')")}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), b AS (
  SELECT item_id,
         list_filter(regexp_split_to_array({LOW.format("coalesce(text, '')")}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s : s + least(len(w), 13) - 1], ' ') AS run
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT r, n, s, array_to_string(w[s : s + n - 1], ' ') AS run
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)
), hit AS (SELECT r, n, s, item_id FROM dw JOIN win USING (n, run)),
pos AS (SELECT DISTINCT r, unnest(range(s, s + n)) AS p FROM hit),
np AS (SELECT r, count(*) AS n_hit FROM pos GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
       FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN np USING (r) LEFT JOIN it USING (r)
"""


@QUERIES.add("op1_decontaminate", "LLM1", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of every document that the benchmark holds, in windows of 13 words."""
    judged = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        F.col("k_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
rules(k, kind, pat, grp, least_n) AS (VALUES
  (0, 'assign', '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  (1, 'access', 'AKIA[A-Z0-9]+', 0, 20), (2, 'hex', '[0-9a-f]{24,}', 0, 24),
  (3, 'github', 'gh[pousr]_[A-Za-z0-9]{36,}', 0, 0), (4, 'slack', 'xox[abprs]-[A-Za-z0-9-]{10,}', 0, 0),
  (5, 'jwt', 'eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}', 0, 0),
  (6, 'pem', '-----BEGIN [A-Z ]*PRIVATE KEY-----', 0, 0), (7, 'google', 'AIza[A-Za-z0-9_-]{35}', 0, 0)),
m AS (
  SELECT r, k, kind, least_n, {0} FROM d, rules
), n AS (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM m WHERE len(whole) > 0),
s AS (
  SELECT r, k, kind, len(val[i]) AS v, least_n,
         list_sum(list_transform(gap[1:i], lambda x: len(x))) + list_sum(list_transform(whole[1:i], lambda x: len(x))) AS e, len(whole[i]) AS l
  FROM n
), f AS (SELECT r, k, kind, CAST(e - l AS BIGINT) AS b, CAST(e AS BIGINT) AS e FROM s WHERE v >= least_n),
g AS (
  SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, k) FILTER (k < 3) AS base,
         string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, k) AS spans
  FROM f GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""


def _per_rule(call: str) -> str:
    """DuckDB wants a constant pattern, so each rule gets a branch of its own."""
    quoted = lambda rule: rule.pattern.replace("'", "''")
    return "CASE k " + " ".join(
        f"WHEN {n} THEN " + call.format(pattern=f"'{quoted(rule)}'", group=rule.value) for n, rule in enumerate(secret_scan.RULES)
    ) + " END"


OP9_SQL = OP9_SQL.replace(
    "{0}",
    f"{_per_rule('regexp_extract_all(t, {pattern}, 0)')} AS whole, "
    f"{_per_rule('regexp_extract_all(t, {pattern}, {group})')} AS val, "
    f"{_per_rule('regexp_split_to_array(t, {pattern})')} AS gap",
)


@QUERIES.add("op9_secrets", "LLM9", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document as spans."""
    kinds = [rule.kind for rule in secret_scan.RULES]
    base = len(secret_scan.BASE_RULES)
    count = lambda n: F.size(F.filter("found", lambda s: s["rule"] == n)).cast("long")
    first = F.filter("found", lambda s: s["rule"] < base)
    return secret_scan.scan(table(spark, sf_dir, "documents")).select(
        F.col("k_id").alias("doc_id"),
        *[count(n).alias(f"n_{kinds[n]}") for n in range(base)],
        F.sha2(secret_scan.span_text(first, kinds), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("found"), kinds).alias("spans"),
    )


OP10_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, t, {SQL_WORDS.format("t")} AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
), g AS (
  SELECT r, s, array_to_string(w[s : s + 4], ' ') AS run
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS s FROM d WHERE len(w) >= 5)
), twice AS (SELECT r, s FROM (SELECT r, s, count(*) OVER (PARTITION BY r, run) AS n FROM g) WHERE n > 1),
rep AS (
  SELECT r, sum(least(5, coalesce(nxt - s, 5))) AS n
  FROM (SELECT r, s, lead(s) OVER (PARTITION BY r ORDER BY s) AS nxt FROM twice) GROUP BY r
), x AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep USING (r)
), y AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         CAST(CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
         + CASE WHEN n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines AND n_lines > 3 THEN 8 ELSE 0 END
         + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 40 * n_words THEN 32 ELSE 0 END AS BIGINT) AS failed_bits
  FROM x
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_bits & 15 = 0 AS kept, failed_bits
FROM y
"""
QUALITY_POLICY = "v2"


@QUERIES.add("op10_quality", "LLM10", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of every document and the verdict of the policy in force."""
    rows = quality.ledger(table(spark, sf_dir, "documents"))
    base_failed = F.col("failed_bits").bitwiseAND(F.lit(quality.mask_of(quality.BASE))) != 0
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & quality.kept_by(QUALITY_POLICY)).alias("kept"),
        "failed_bits",
    )


OP2_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, {SQL_WORDS.format(LOW.format("coalesce(text, '')"))} AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
e AS (
  SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * m >= 85 * (p.n + q.n - m)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id, d.doc_id = min(r.b) AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.a = d.doc_id GROUP BY d.doc_id, n.n
"""


@QUERIES.add("op2_near_dedup", "LLM2", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, similarity of 0.85 or more."""
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)
    return found.select(F.col("k_id").alias("doc_id"), "n_shingles", "component_id", "kept")


@QUERIES.add("op4_language", "LLM4", "")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four fifths of the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id")) == 0
    return language_id.identify(docs, ~held_out).select(
        "doc_id",
        held_out.alias("held_out"),
        "language.lang_pred",
        "language.score",
        language_id.accepted(F.col("language")).alias("accepted"),
    )


@QUERIES.add("op6_sharding", "LLM6", "")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    return sharding.placed(docs).select(
        "row.doc_id",
        "size",
        "row.text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# Dated list entries and fetch days that every engine derives from the pages in the same way.
DAY_ZERO = "DATE '2023-01-01'"
DAYS = 720


def drawn(text: Column, most: int) -> Column:
    """A number below ``most`` that the text decides."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("long") % most


def listed_hosts(pages: DataFrame) -> DataFrame:
    """Two lists over the hosts of the pages: hosts come, go and come back; parent domains come and stay."""
    hosts = pages.select(url_filter.host_of(F.col("url")).alias("host")).filter("host <> ''").distinct()
    day = lambda n: F.date_add(F.expr(DAY_ZERO), n.cast("int"))
    first, gap = drawn(F.col("host"), DAYS), drawn(F.concat(F.lit("gap:"), "host"), 200) + 1
    turns = F.array(
        F.struct(day(first).alias("day"), F.lit("add").alias("action")),
        F.struct(day(first + gap).alias("day"), F.lit("remove").alias("action")),
        F.struct(day(first + 2 * gap).alias("day"), F.lit("add").alias("action")),
    )
    ads = hosts.filter(drawn(F.concat(F.lit("ads:"), "host"), 2) == 0).select(F.lit("ads").alias("list"), F.col("host").alias("pattern"), F.inline(turns))
    parent = F.concat_ws(".", F.slice(F.split("host", r"\."), -2, 2))
    parents = hosts.filter(F.size(F.split("host", r"\.")) > 1).select(parent.alias("pattern")).distinct()
    some = parents.filter(drawn(F.concat(F.lit("mal:"), "pattern"), 2) == 0)
    malware = some.select(F.lit("malware").alias("list"), "pattern", day(drawn(F.col("pattern"), DAYS)).alias("day"), F.lit("add").alias("action"))
    return ads.unionByName(malware)


OP7_SQL = r"""
WITH p AS (
  SELECT page_id, url, rtrim(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#]*@)?([^/?#:]*)', 1)), '.') AS host,
         DATE '2023-01-01' + CAST(CAST('0x' || substr(md5(coalesce(CAST(page_id AS VARCHAR), '')), 1, 7) AS BIGINT) % 720 AS INTEGER) AS day
  FROM pages
), h AS (SELECT DISTINCT host, string_split(host, '.') AS l FROM p WHERE host <> ''),
a AS (
  SELECT host, CAST('0x' || substr(md5(host), 1, 7) AS BIGINT) % 720 AS f, CAST('0x' || substr(md5('gap:' || host), 1, 7) AS BIGINT) % 200 + 1 AS g
  FROM h WHERE CAST('0x' || substr(md5('ads:' || host), 1, 7) AS BIGINT) % 2 = 0
), q AS (SELECT DISTINCT array_to_string(l[-2:], '.') AS pattern FROM h WHERE len(l) > 1),
e AS (
  SELECT 'ads' AS list, host AS pattern, f AS n, 'add' AS action FROM a
  UNION ALL SELECT 'ads', host, f + g, 'remove' FROM a UNION ALL SELECT 'ads', host, f + 2 * g, 'add' FROM a
  UNION ALL SELECT 'malware', pattern, CAST('0x' || substr(md5(pattern), 1, 7) AS BIGINT) % 720, 'add' FROM q
  WHERE CAST('0x' || substr(md5('mal:' || pattern), 1, 7) AS BIGINT) % 2 = 0
), k AS (
  SELECT p.page_id, p.url, p.day, unnest(list_distinct(list_transform(range(1, greatest(len(string_split(host, '.')), 2)), lambda i: array_to_string(string_split(host, '.')[i:], '.')))) AS pattern
  FROM p WHERE host <> ''
), m AS (
  SELECT k.page_id, k.url, e.list, arg_max(e.action, e.n) AS last
  FROM k JOIN e ON e.pattern = k.pattern AND DATE '2023-01-01' + CAST(e.n AS INTEGER) <= k.day GROUP BY k.page_id, k.url, e.list, e.pattern
), b AS (SELECT page_id, url, string_agg(DISTINCT list, ',' ORDER BY list) AS lists FROM m WHERE last = 'add' GROUP BY page_id, url)
SELECT p.page_id, p.host, p.day AS fetch_day, coalesce(b.lists, '') AS lists, b.lists IS NOT NULL AS blocked
FROM p LEFT JOIN b ON p.page_id IS NOT DISTINCT FROM b.page_id AND p.url IS NOT DISTINCT FROM b.url
"""


@QUERIES.add("op7_url_filters", "LLM7", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against the list entries that were active on the day it was fetched."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.date_add(F.expr(DAY_ZERO), drawn(F.coalesce(F.col("page_id").cast("string"), F.lit("")), DAYS).cast("int"))
    found = url_filter.active_lists(pages.withColumn("day", fetched), listed_hosts(pages), "page_id", "url", "day")
    return found.select(
        F.col("id").alias("page_id"),
        url_filter.host_of(F.col("url")).alias("host"),
        F.col("day").alias("fetch_day"),
        F.array_join("lists", ",").alias("lists"),
        (F.size("lists") > 0).alias("blocked"),
    )


# The tree of the mix: a domain is every fourth source, languages and domains are weighted, sources are equal.
MIX_WEIGHTS = {
    "domain": {"web0": 4, "web1": 3, "web2": 2, "web3": 2},
    "lang": {"en": 6, "de": 2, "fr": 2, "es": 1},
}
MIX_DOMAIN = "concat('web', coalesce(try_cast(regexp_extract(source, '([0-9]+)', 1) AS bigint), 0) % 4)"
MIX_LEVELS = {"domain": MIX_DOMAIN, "lang": "lang", "source": "source"}


def _mix_sql() -> str:
    weight = {
        level: "CASE " + " ".join(f"WHEN {level} = '{k}' THEN {v}" for k, v in named.items()) + " ELSE 1 END"
        for level, named in MIX_WEIGHTS.items()
    } | {"source": "1"}
    parts = [
        f"""
WITH d AS (
  SELECT doc_id, coalesce({MIX_DOMAIN}, '') AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         md5(coalesce(text, '')) AS text_hash, CAST(len({SQL_WORDS.format("coalesce(text, '')")}) AS BIGINT) AS tokens
  FROM documents
), leaf AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS held, sum(tokens)::BIGINT * 2 AS cap FROM d GROUP BY ALL),
b0 AS (SELECT least((SELECT sum(held)::BIGINT * 4 // 5 FROM leaf), (SELECT sum(cap)::BIGINT FROM leaf)) AS budget)"""
    ]
    for depth, level in enumerate(MIX_LEVELS, 1):
        path, above = ", ".join(list(MIX_LEVELS)[:depth]), ", ".join(list(MIX_LEVELS)[: depth - 1])
        by = f"PARTITION BY {above}" if above else ""
        join = f"JOIN b{depth - 1} USING ({above})" if above else "CROSS JOIN b0"
        parts.append(
            f"""
n{depth} AS (SELECT {path}, cap, {weight[level]} AS w, budget AS pb FROM (SELECT {path}, sum(cap)::BIGINT AS cap FROM leaf GROUP BY ALL) {join}),
c{depth} AS (
  SELECT *, sum(w) OVER ({by})::BIGINT AS aw, coalesce(sum(cap) OVER x, 0)::BIGINT AS cb, coalesce(sum(w) OVER x, 0)::BIGINT AS wb
  FROM n{depth} WINDOW x AS ({by} ORDER BY cap / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f{depth} AS (SELECT *, cap * (aw - wb) <= (pb - cb) * w AS filled FROM c{depth}),
s{depth} AS (
  SELECT *, coalesce(sum(cap) FILTER (filled) OVER ({by}), 0)::BIGINT AS fc, coalesce(sum(w) FILTER (filled) OVER ({by}), 0)::BIGINT AS fw FROM f{depth}
), b{depth} AS (SELECT {path}, CAST(CASE WHEN filled THEN cap ELSE ((pb - fc) * w) // nullif(aw - fw, 0) END AS BIGINT) AS budget FROM s{depth})"""
        )
    return (
        ",".join(parts)
        + """,
plan AS (
  SELECT domain, lang, source, budget, CASE WHEN held > 0 THEN budget // held ELSE 0 END AS epochs,
         CASE WHEN held > 0 THEN budget % held ELSE 0 END AS rest
  FROM leaf JOIN b3 USING (domain, lang, source)
), o AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source
                              ORDER BY md5('mix-1:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || text_hash)) AS upto
  FROM d JOIN plan USING (domain, lang, source)
)
SELECT doc_id, domain, lang, source, tokens, budget, CAST(epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS n_taken FROM o
"""
    )


@QUERIES.add("op8_mixing", "LLM8", _mix_sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often every document is taken into a mix of four fifths of all tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    found = mixing.selection(docs, MIX_LEVELS, MIX_WEIGHTS)
    return found.select(F.col("id").alias("doc_id"), *MIX_LEVELS, "tokens", "budget", "n_taken")


@QUERIES.add("op5_pii", "LLM5", "")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document as spans, and the fingerprint of its sanitised text."""
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("k_id").alias("doc_id"),
        "n_email",
        "n_ip",
        "n_card",
        "n_phone",
        F.sha2("base", 256).alias("base_sha256"),
        "spans",
        "n_term",
        F.sha2("sanitised", 256).alias("sanitised_sha256"),
    )


@QUERIES.add("op3_lm_scores", "LLM3", "")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = lm.scores(docs, fold(F.col("doc_id")) != 1)
    return found.select(
        F.col("k_id").alias("doc_id"),
        (fold(F.col("k_id")) == 1).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


OP12_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array({LOW.format("coalesce(text, '')")}, '[{lexical_search.BETWEEN}]+'), lambda x: x <> '') AS w
  FROM documents
), i AS (
  SELECT DISTINCT item_id, unnest(list_filter(regexp_split_to_array({LOW.format("coalesce(text, '')")}, '[{lexical_search.BETWEEN}]+'), lambda x: x <> '')) AS term
  FROM benchmark
), whole AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM tf CROSS JOIN whole GROUP BY term, n_docs
), m AS (SELECT r, doc_id, 100 - 50 + ((50 * CAST(len(w) AS BIGINT) * n_docs) // l) AS m FROM d CROSS JOIN whole),
s AS (
  SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM i JOIN weight USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY item_id, r, doc_id
), p AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM p WHERE rank <= 50
"""


@QUERIES.add("op12_search", "LLM12", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    found = lexical_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=50)
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


@QUERIES.add("op13_spelling", "LLM13", "")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among all words of the documents."""
    found = spelling.variants(table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@QUERIES.add("op11_main_text", "LLM11", "")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.main_text(pages).select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))
