"""Ranked lexical search: bundles of items pass from term owner to term owner and gather integer scores.

Documents are cut into blocks as they are read; a block's postings are one row
per term. The terms of the items are dealt to owners by document frequency, the
rarest first, so that a bundle stays sparse for as long as possible. At every
owner the bundle of a block is cogrouped with the postings the owner holds for
that block; the owner adds its terms' contributions and hands the bundle on.
The last owner keeps the best of each block, and the best of all are ranked.

Nothing is pruned: a document's score is the sum over all terms of the item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.llm.text import lower_ascii, stored, words

# Everything below U+0080 that is not a letter or digit of ASCII.
BETWEEN = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
OWNERS = 3
BUNDLE = 256
# Items are searched in groups with at most about so many (item, term) rows, so
# that the vocabulary every task holds is bounded whatever the number of items.
PAIRS = 1_000_000

# In UTF-8 all bytes of other characters are above 0x7F: letters and digits stay, A-Z in lower case, the rest is a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(_FOLD).split()


def _block_rows(batch: pa.RecordBatch, vocabulary: dict[bytes, int], names: list[str], block: int, id_type: pa.DataType) -> pa.RecordBatch:
    """One row per term that the block holds, and one with the ids and lengths of its documents; documents in order of id."""
    order = pc.sort_indices(batch.column(0), null_placement="at_end")
    ids, texts = batch.column(0).take(order), batch.column(1).take(order)
    lengths, term_parts, at_parts = [], [], []
    for at, text in enumerate(texts.cast(pa.binary()).to_pylist()):
        own = terms_of(text)
        lengths.append(len(own))
        known = [n for n in map(vocabulary.get, own) if n is not None]
        term_parts.append(np.array(known, dtype=np.int64))
        at_parts.append(np.full(len(known), at, dtype=np.int64))
    flat = np.concatenate(term_parts) * len(lengths) + np.concatenate(at_parts)
    cells, counts = np.unique(flat, return_counts=True)
    term, at = np.divmod(cells, len(lengths))
    first = np.flatnonzero(np.diff(term, prepend=-1))
    some = term[first]
    offsets = np.append(first, len(term)).astype(np.int32)
    no_ids = pa.ListArray.from_arrays(pa.array([0] * (len(some) + 1), pa.int32()), pa.array([], id_type))
    own_ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.cast(id_type))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block] * (len(some) + 1), pa.int64()),
            pa.array([names[n] for n in some] + [None], pa.string()),
            pa.concat_arrays([pa.ListArray.from_arrays(pa.array(offsets), pa.array(at.astype(np.int32))), pa.array([[]], pa.list_(pa.int32()))]),
            pa.concat_arrays(
                [
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(counts.astype(np.int32))),
                    pa.array([lengths], pa.list_(pa.int32())),
                ]
            ),
            pa.concat_arrays([no_ids, own_ids]),
        ],
        names=["block", "term", "at", "tf", "ids"],
    )


def _postings(docs: DataFrame, id_col: str, text_col: str, names: list[str]) -> DataFrame:
    """(block, term, at, tf, ids): postings by block, and with a null term the block's lengths as ``tf`` and its ids."""
    held = docs.sparkSession.sparkContext.broadcast(names)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = held.value
        vocabulary = {name.encode(): n for n, name in enumerate(names)}
        first = TaskContext.get().partitionId() << 32
        for n, batch in enumerate(batches):
            if batch.num_rows:
                yield _block_rows(batch, vocabulary, names, first + n, batch.schema.field(0).type)

    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("term", T.StringType()),
            T.StructField("at", T.ArrayType(T.IntegerType())),
            T.StructField("tf", T.ArrayType(T.IntegerType())),
            T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)),
        ]
    )
    return rows.mapInArrow(read, schema)


def _owner(df: F.Column, by_size: list[tuple[int, int]], owners: int) -> F.Column:
    """The owner of a term: equal shares of the postings in order of document frequency (power of two, postings)."""
    total, so_far, owner = sum(n for _, n in by_size), 0, F.lit(0)
    for size, n in sorted(by_size):
        owner = F.when(F.floor(F.log2(df)) >= size, F.lit(min(owners - 1, so_far * owners // max(total, 1)))).otherwise(owner)
        so_far += n
    return owner


def _added(n_docs: int, all_terms: int, top: int | None):
    """The work of an owner on one bundle and block; with ``top`` set, only the best of the block are handed on."""

    def add(bundles: pd.DataFrame, postings: pd.DataFrame) -> pd.DataFrame:
        is_block = postings["weight"].isna().to_numpy()
        of_block = postings[is_block].iloc[0]
        length = np.asarray(of_block["tf"], dtype=np.int64)
        m = 50 + (50 * length * n_docs) // all_terms
        scores: dict[int, np.ndarray] = {}
        for item, at, score in zip(bundles["k_item"], bundles["at"], bundles["score"]):
            scores[item] = np.zeros(len(length), dtype=np.int64)
            scores[item][at] = score
        mine = postings[~is_block]
        for items, weight, at, tf in zip(mine["items"], mine["weight"], mine["at"], mine["tf"]):
            tf = np.asarray(tf, dtype=np.int64)
            gain = int(weight) * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[at]))
            for item in items:
                if item not in scores:
                    scores[item] = np.zeros(len(length), dtype=np.int64)
                scores[item][at] += gain
        out = []
        for item, dense in scores.items():
            at = np.flatnonzero(dense)
            if top is not None and len(at) > top:
                # Places are in order of id, so equal scores keep the smaller id.
                least = np.partition(dense[at], len(at) - top)[len(at) - top]
                at = at[dense[at] >= least]
                at = np.sort(at[np.argsort(-dense[at], kind="stable")[:top]])
            if len(at):
                out.append((of_block["block"], of_block["bundle"], item, at.astype(np.int32), dense[at]))
        return pd.DataFrame(out, columns=["block", "bundle", "k_item", "at", "score"])

    return add


BUNDLES = "block long, bundle int, k_item long, at array<int>, score array<long>"


def _search(docs: DataFrame, id_col: str, text_col: str, pairs: DataFrame, top: int, owners: int) -> DataFrame:
    """(k_item, rank, id, score) for the items of ``pairs`` (k_item, term)."""
    spark = docs.sparkSession
    names = [row.term for row in pairs.select("term").distinct().collect()]
    postings = stored(_postings(docs, id_col, text_col, names), "postings")
    blocks = postings.filter("term IS NULL")
    whole = blocks.select(
        F.sum(F.size(F.filter("tf", lambda n: n > 0))).alias("n"),
        F.sum(F.aggregate("tf", F.lit(0).cast("long"), lambda a, n: a + n)).alias("l"),
    ).first()
    n_docs, all_terms = whole.n or 0, max(whole.l or 0, 1)
    df = stored(postings.filter("term IS NOT NULL").groupBy("term").agg(F.sum(F.size("at")).alias("df")), "frequencies")
    by_size = [(row.size, row.n) for row in df.groupBy(F.floor(F.log2("df")).alias("size")).agg(F.sum("df").alias("n")).collect()]
    n_bundles = -(-pairs.select("k_item").distinct().count() // BUNDLE)
    weight = F.floor(F.lit(1000) * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    plan = stored(
        pairs.join(df, "term")
        .select("term", "k_item", F.pmod("k_item", F.lit(max(n_bundles, 1))).cast("int").alias("bundle"), weight.alias("weight"), _owner(F.col("df"), by_size, owners).alias("owner"))
        .filter("weight > 0")
        .groupBy("owner", "bundle", "term", "weight")
        .agg(F.collect_list("k_item").alias("items")),
        "search-plan",
    )
    everywhere = blocks.select(
        "block", F.explode(F.sequence(F.lit(0), F.lit(max(n_bundles, 1) - 1))).alias("bundle"), F.lit(None).cast("array<long>").alias("items"), F.lit(None).cast("long").alias("weight"), "at", "tf"
    )
    bundles = spark.createDataFrame([], BUNDLES)
    for owner in range(owners):
        mine = postings.filter("term IS NOT NULL").join(plan.filter(F.col("owner") == owner), "term").select("block", "bundle", "items", "weight", "at", "tf")
        add = _added(n_docs, all_terms, top if owner == owners - 1 else None)
        bundles = bundles.groupBy("block", "bundle").cogroup(mine.unionByName(everywhere).groupBy("block", "bundle")).applyInPandas(add, BUNDLES)
    best = bundles.select("block", "k_item", F.explode(F.arrays_zip("at", "score")).alias("hit"))
    named = best.join(blocks.select("block", "ids"), "block").select("k_item", F.get("ids", F.col("hit.at")).alias("id"), F.col("hit.score").alias("score"))
    place = F.row_number().over(Window.partitionBy("k_item").orderBy(F.desc("score"), F.asc_nulls_last("id")))
    return named.withColumn("rank", place).filter(F.col("rank") <= top)


def ranked(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", top: int = 50, owners: int = OWNERS
) -> DataFrame:
    """(item, rank, id, score): the ``top`` documents of every item, scores above 0, best first.

    Equal scores are in order of id, null ids last. Null and empty texts hold no
    term: such a document is never found, such an item finds nothing. Repeated
    rows of documents are documents of their own; repeated rows of an item (id
    and text) are one item, an id with two texts is two. No documents or no
    items give no rows. Only the named columns are read, so further columns,
    whatever their names, have no effect.
    """
    item_type = items.schema[item_col].dataType
    text = F.coalesce(F.col(item_text_col), F.lit(""))
    keyed = stored(
        items.select(F.col(item_col).alias("item"), text.alias("text")).distinct().withColumn("k_item", F.xxhash64("item", "text", F.col("item").isNull())),
        "items",
    )
    pairs = stored(keyed.select("k_item", F.explode(words(lower_ascii(F.col("text")), BETWEEN)).alias("term")).distinct(), "item-terms")
    groups = max(1, -(-pairs.count() // PAIRS))
    found = None
    for group in range(groups):
        mine = pairs if groups == 1 else pairs.filter(F.pmod(F.xxhash64("k_item"), F.lit(groups)) == group)
        part = _search(docs, id_col, text_col, mine, top, owners)
        found = part if found is None else found.unionByName(part)
    return found.join(keyed.select("k_item", "item"), "k_item").select(F.col("item").cast(item_type), "rank", "id", "score")
