"""Benchmark decontamination by winnowing.

Of every ``window - k + 1`` consecutive k-word hashes the smallest is kept, in
documents and benchmark items alike. A run of ``window`` equal words holds the
same hashes on both sides, so both keep the same one: no shared run of that
length can be missed. Documents are joined with the benchmark on kept hashes
only, and each hit is extended to the windows around it and compared word for
word. Items shorter than a window are one window of their own length, whose
hash at every position takes the place of the kept ones.

Main path: DataFrame functions only. Defined results: a null or empty text has
no words and is clean; an item without words matches nothing; an item without
an id marks words but is not listed; rows that share an id are judged each by
its own text; repeated rows and items change nothing but the number of rows;
further columns, of any name, play no part in the match.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.text import KEY, PUNCTUATION, gram_hashes, keyed, let, lower_ascii, same_key, stored, words

WINDOW = 13
K = 8
# Rows up to which a side is sent to every task: at most 16 bytes each in the
# case of hashes, and 13 words in that of windows.
BROADCAST_HASHES = 2_000_000
BROADCAST_WINDOWS = 100_000


def tokens(text: Column) -> Column:
    return words(lower_ascii(F.coalesce(text, F.lit(""))), PUNCTUATION)


def _kept(df: DataFrame, k: int, keep_of: int) -> DataFrame:
    """Rows (.., at, hash): the winnowed k-word hashes of column ``words``, positions from 1."""

    def smallest(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(hashes) - keep_of + 1, F.lit(1)))
        if keep_of == 1:
            return F.transform(hashes, lambda h, i: F.struct((i + 1).cast("int").alias("at"), h.alias("hash")))
        at = F.array_distinct(
            F.transform(
                starts,
                lambda i: let(
                    F.slice(hashes, i, keep_of),
                    lambda part: (F.array_position(part, F.array_min(part)) + i - 1).cast("int"),
                ),
            )
        )
        return F.transform(at, lambda p: F.struct(p.alias("at"), F.get(hashes, p - 1).alias("hash")))

    kept = let(gram_hashes(F.col("words"), k), lambda h: F.when(F.size(h) > 0, smallest(h)))
    return df.select(*[c for c in df.columns if c != "words"], F.inline(kept))


def _windows(items: DataFrame, length: int, whole: bool) -> DataFrame:
    """Distinct windows of that many words with the sorted ids of the items that hold them."""
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    fits = F.size("words") == length if whole else F.size("words") >= length
    return (
        items.filter(fits)
        .select("item", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("words", i, length), " "))).alias("run"))
        .groupBy("run")
        .agg(F.collect_set("item").alias("items"))
    )


def _small(df: DataFrame, limit: int) -> DataFrame:
    """The frame, sent to all tasks when it is counted to be small, else left to a shuffled join."""
    return F.broadcast(df) if df.count() <= limit else df


def shared_runs(docs: DataFrame, items: DataFrame, window: int, k: int) -> DataFrame:
    """Rows (key, start, length, items): every window of an item found in a document.

    ``docs`` is keyed with its words, ``items`` has item and words.
    """
    sizes = items.select(F.size("words").alias("n")).filter(f"n BETWEEN 1 AND {window - 1}").distinct()
    plans = [(n, n, 1) for n in sorted(row.n for row in sizes.collect())] + [(window, k, window - k + 1)]
    found = []
    for length, gram, keep_of in plans:
        own = items.filter(F.size("words") == length) if length < window else items.filter(F.size("words") >= length)
        hashes = stored(_kept(own.select("words"), gram, keep_of).select("hash").distinct(), "item-hashes")
        hits = stored(
            _kept(docs.select(*KEY, "words"), gram, keep_of)
            .join(_small(hashes, BROADCAST_HASHES), "hash", "left_semi")
            .groupBy(*KEY)
            .agg(F.collect_set("at").alias("places")),
            "hits",
        )
        last = F.size("words") - length + 1
        around = F.array_distinct(
            F.flatten(
                F.transform(
                    "places",
                    lambda p: F.when(
                        F.greatest(p - (length - gram), F.lit(1)) <= F.least(p, last),
                        F.sequence(F.greatest(p - (length - gram), F.lit(1)), F.least(p, last)),
                    ).otherwise(F.array().cast("array<int>")),
                )
            )
        )
        if (hits.agg(F.sum(F.size("places"))).first()[0] or 0) <= BROADCAST_HASHES:
            hits = F.broadcast(hits)
        runs = (
            docs.join(hits, same_key(docs, hits))
            .select(docs["k_id"], docs["k_text"], docs["words"], F.col("places"))
            .select(*KEY, "words", F.explode(around).alias("start"))
            .select(*KEY, "start", F.array_join(F.slice("words", F.col("start"), length), " ").alias("run"))
        )
        sought = stored(_windows(items, length, length < window), "item-windows")
        found.append(
            runs.join(_small(sought, BROADCAST_WINDOWS), "run").select(*KEY, "start", F.lit(length).alias("length"), "items")
        )
    return reduce(DataFrame.unionByName, found)


def _covered(spans: Column) -> Column:
    """The number of words in the union of (start, length), sorted by start."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def step(state: Column, span: Column) -> Column:
        end = span["start"] + span["length"]
        return F.struct(
            (state["n"] + F.greatest(end - F.greatest(span["start"], state["end"]), F.lit(0))).alias("n"),
            F.greatest(state["end"], end).alias("end"),
        )

    return F.aggregate(spans, zero, step, lambda state: state["n"])


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    k: int = K,
    share: int = 20,
) -> DataFrame:
    """Per document: its key, n_words, n_hit, items (sorted ids) and contaminated.

    A document is contaminated if ``share * n_hit >= n_words > 0`` with a hit.
    """
    items = stored(
        benchmark.select(F.col(item_col).cast("string").alias("item"), tokens(F.col(item_text_col)).alias("words")), "items"
    )
    all_docs = keyed(docs, id_col, text_col)
    split = all_docs.select(*KEY, tokens(F.col("text")).alias("words"))
    hit = (
        shared_runs(split, items, window, k)
        .groupBy(*KEY)
        .agg(
            _covered(F.array_sort(F.collect_set(F.struct("start", "length")))).alias("n_hit"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
    counted = split.select(*KEY, F.size("words").cast("long").alias("n_words"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return counted.join(hit, same_key(counted, hit), "left").select(
        counted["k_id"],
        counted["k_text"],
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (F.lit(share) * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    bad = contamination(docs, benchmark, **options).filter("contaminated").select(*KEY).distinct()
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    row = keyed(docs, id_col, text_col, F.struct("*").alias("row"))
    return row.join(bad, same_key(row, bad), "left_anti").select("row.*")
