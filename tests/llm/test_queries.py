"""The registered queries: against SQL where there is one, else against plain Python over every row."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from oracle import connect, differences

import __spark_entry__ as driver
import corpus_pipeline
from spendlake.llm.queries import QUERIES
from spendlake.llm.text import table

SF = "/root/testdata/sf0.001"
SPACE = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def docs():
    return connect(SF).execute("SELECT doc_id, text, lang FROM documents").fetchall()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


@pytest.mark.parametrize("name", sorted(name for name, query in QUERIES.items() if query.sql))
def test_query_agrees_with_sql(spark, name):
    found = differences(driver.queries()[name](spark, SF), connect(SF), driver.oracle_sql()[name])
    assert [line for line in found if "date against DATE" not in line] == []


@pytest.mark.parametrize("name", ["op1_decontaminate", "op8_mixing", "op9_secrets", "op10_quality"])
def test_native_queries_run_no_python(spark, plan, name):
    text = plan(QUERIES[name].run(spark, SF))
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_lm_base_scores(spark, docs):
    words = {doc_id: [*SPACE.findall(lower(text)), ""] for doc_id, text, _ in docs}
    counts = Counter(w for doc_id, own in words.items() if fold(doc_id) != 1 for w in own)
    total, distinct = sum(counts.values()), len(counts)
    rows = QUERIES["op3_lm_scores"].run(spark, SF).collect()
    assert len(rows) == len(docs)
    for row in rows:
        own = words[row.doc_id]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own)
        assert (row.held_out, row.n_tokens, row.n_known) == (fold(row.doc_id) == 1, len(own), sum(w in counts for w in own))
        assert row.train_tokens == total and math.isclose(row.base_score, base, rel_tol=1e-9)
        assert row.score < 0
    held = [row for row in rows if row.held_out]
    assert sum(row.score for row in held) > sum(row.base_score for row in held)


def test_lm_learns_nothing_from_held_out_texts(spark, docs):
    from spendlake.llm import lm
    from spendlake.llm.queries import fold as fold_column
    from pyspark.sql import functions as F

    some = table(spark, SF, "documents").select("doc_id", "text")
    changed = some.withColumn("text", F.when(fold_column(F.col("doc_id")) == 1, F.lit("other words")).otherwise(F.col("text")))
    train = fold_column(F.col("doc_id")) != 1
    take = lambda df: {r.k_id: round(r.score, 6) for r in lm.scores(df, train).collect() if fold(r.k_id) != 1}
    assert take(some) == take(changed)


def test_language_of_held_out_documents(spark, docs):
    lang = {doc_id: lang for doc_id, _, lang in docs}
    rows = QUERIES["op4_language"].run(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(lang)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {d for d in lang if fold(d) == 0}
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def base_spans(text):
    """The patterns as they are stated, left to right and kind by kind."""

    def luhn(digits):
        total = 0
        for n, d in enumerate(reversed(digits)):
            d = int(d) * (1 + n % 2)
            total += d - 9 * (d > 9)
        return total % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m[0])
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ]
    return [(kind, m.start(), m.end()) for kind, pattern, ok in kinds for m in re.finditer(pattern, text or "") if ok(m)]


def test_pii_base(spark, docs):
    texts = {doc_id: text for doc_id, text, _ in docs}
    rows = QUERIES["op5_pii"].run(spark, SF).collect()
    assert len(rows) == len(docs)
    for row in rows:
        spans = base_spans(texts[row.doc_id])
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert row.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and row.spans.startswith(text)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [
            sum(k == kind for k, _, _ in spans) for kind in ("email", "ip", "card", "phone")
        ]


def test_sharding_law(spark, docs):
    rows = QUERIES["op6_sharding"].run(spark, SF).collect()
    size = {doc_id: len((text or "").encode()) + 8 for doc_id, text, _ in docs}
    assert {r.doc_id: r.size for r in rows} == size
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r)
    assert set(shards) == set(range(24))
    for own in shards.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    sizes = [sum(r.size for r in own) for own in shards.values()]
    # A document is not cut: a shard is off by at most one at either end.
    assert max(sizes) - min(sizes) <= 2 * max(size.values())
    crc = {doc_id: zlib.crc32((text or "").encode()) for doc_id, text, _ in docs}
    assert all(r.text_crc32 == crc[r.doc_id] and r.law == "bytes" and r.grown_shard is None for r in rows)


def jaccard_groups(docs, size, share):
    """Brute force: the smallest id of every group."""
    sets = {}
    for doc_id, text in docs:
        w = SPACE.findall(lower(text))
        sets[doc_id] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    parent = {doc_id: doc_id for doc_id in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b]):
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {doc_id: root(doc_id) for doc_id in ids}


def test_pipeline_stages(spark):
    """Each stage on its own input, by brute force where it has one."""
    before = table(spark, SF, "documents")
    start = before
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, SF).cache()
        old, new = before.collect(), after.collect()
        if n < 4:
            assert after.columns == start.columns
        if name == "language":
            assert len(new) >= 0.97 * len(old) and {r.doc_id for r in new} <= {r.doc_id for r in old}
        if name == "near_duplicates":
            groups = jaccard_groups([(r.doc_id, r.text) for r in old], 5, 80)
            assert sorted(r.doc_id for r in new) == sorted(d for d, g in groups.items() if d == g)
        if name == "decontamination":
            before.createOrReplaceTempView("kept")
            con = connect(SF)
            con.register("documents_now", before.select("doc_id", "text").toPandas())
            sql = QUERIES["op1_decontaminate"].sql.replace("FROM documents\n", "FROM documents_now\n")
            bad = {row[0] for row in con.execute(f"SELECT doc_id FROM ({sql}) WHERE contaminated").fetchall()}
            assert bad and sorted(r.doc_id for r in new) == sorted(r.doc_id for r in old if r.doc_id not in bad)
        if name == "mixing":
            con = connect(SF)
            con.register("documents_now", before.toPandas())
            sql = QUERIES["op8_mixing"].sql.replace("FROM documents\n", "FROM documents_now\n")
            want = Counter({row[0]: row[1] for row in con.execute(f"SELECT doc_id, n_taken FROM ({sql})").fetchall()})
            assert Counter(r.doc_id for r in new) == +want
        if name == "sharding":
            assert Counter(r.doc_id for r in new) == Counter(r.doc_id for r in old)
            for shard in {r.shard for r in new}:
                slots = sorted(r.slot for r in new if r.shard == shard)
                assert slots == list(range(len(slots)))
        before = after
