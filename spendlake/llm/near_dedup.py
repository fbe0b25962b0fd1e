"""Near-duplicate groups from bottom-k sketches of one hash function.

A document's set is its distinct hashed word n-grams; documents with equal sets
form a class, and everything after that is about classes. The sketch of a class
is the ``k`` smallest hashes. Inverted lists of sketch values give the classes
that overlap; the sketch of the union of two sets estimates their similarity
and discards what is clearly below the threshold; the full sets decide.

Two linked sets share at least ``needed`` sketch values: all of them surely if
both sets fit into their sketches, else but for one link in ten million at the
very threshold (binomial tail of the k smallest values of the union). So values
held by one class only are dropped, and classes left with fewer than ``needed``
values have no partner. The few classes that remain get a larger sketch, which
is the whole set for most of them, and are thinned in the same way. Of those
sketches only the rarest values are searched, as many as any partner must meet,
and two classes meet only where the values that follow could still be enough.
Frequent values are thus left out where rarer ones suffice, without a cap.

Groups of thousands of near copies are not expanded to pairs: every class is
first compared with a leader of its lists, links are merged into components,
and only classes of different components that still meet in a list are compared
in full. No link that could join two components is left out.

Defined results: an empty or null text, or one without words, is alone; fewer
words than the n-gram are one shingle; rows that share an id are documents of
their own with that id; rows that repeat id and text are the same document and
stay or go together; a null id sorts last, so it stands for a group only if all
its ids are null; further columns are not read.
"""

from __future__ import annotations

from functools import cache
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.components import components
from spendlake.llm.text import KEY, gram_hashes, keyed, let, lower_ascii, same_key, stored, words

SKETCH = 64
# Values of the sketch that screens pairs of the classes the first one leaves.
FINE = 512
# Chance that a link exactly at the threshold is estimated away.
MISS = 1e-7
# Star rounds go on while more cross meetings than this per class are ahead and each round leaves no more than this share.
PAIRS_PER_CLASS = 8
WORTHWHILE = 0.8
# Leaders a class is compared with in a star round; what they miss is left to the comparison of all.
LEADERS = 3
# Rows up to which the ids of candidates are sent to every task (24 bytes each).
BROADCAST_IDS = 400_000


@cache
def needed(similarity: float, k: int = SKETCH) -> int:
    """Shared values that linked sets fall short of with a chance below ``MISS``."""
    tail, m = 0.0, 0
    while m < k:
        tail += comb(k, m) * similarity**m * (1 - similarity) ** (k - m)
        if tail > MISS:
            return m
        m += 1
    return m


def shingles(text: Column, size: int) -> Column:
    """The sorted distinct hashes of the word n-grams of a text."""
    tokens = words(lower_ascii(text))
    grams = let(
        tokens,
        lambda w: F.when((F.size(w) > 0) & (F.size(w) < size), F.array(F.xxhash64(w))).otherwise(gram_hashes(w, size)),
    )
    return F.sort_array(F.array_distinct(grams))


def _least_shared(n: Column, similarity: float, k: int) -> Column:
    """Values of a sketch of ``k`` that a partner of a set of ``n`` shares."""
    return F.least(F.lit(needed(similarity, k)), F.ceil(F.lit(similarity) * n - 1e-9)).cast("int")


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """Per row: key, class, set size and sketch."""
    sets = keyed(docs, "doc_id", "text").select(*KEY, shingles(F.col("text"), size).alias("set"))
    return sets.select(
        *KEY,
        F.xxhash64(F.size("set"), "set").alias("c"),
        F.size("set").alias("n"),
        F.slice("set", 1, SKETCH).alias("sketch"),
    )


def _shared(postings: DataFrame, similarity: float, k: int) -> DataFrame:
    """Postings (c, n, v) with the list length ``df``, of classes that may have a partner.

    A value of one class is dropped, then a class with too few values; what
    that leaves alone goes in the next turn.
    """
    for _ in range(3):
        lists = postings.groupBy("v").agg(F.count("*").alias("df")).filter("df > 1")
        postings = stored(postings.drop("df").join(lists, "v"), "postings")
        enough = postings.groupBy("c").agg(F.count("*").alias("s"), F.first("n").alias("size"))
        enough = enough.filter(F.col("s") >= _least_shared(F.col("size"), similarity, k)).select("c")
        postings = postings.join(enough, "c", "left_semi")
    return postings


def _prefix(postings: DataFrame, similarity: float) -> DataFrame:
    """The rarest values of each class, so many that a partner must hold one of them.

    ``left`` is how many values follow in the order from rare to frequent, values
    of the class alone being first; two classes whose first common value is
    followed by ``left1`` and ``left2`` share at most one more than the smaller.
    """
    own = Window.partitionBy("c")
    rank = F.row_number().over(own.orderBy("df", "v"))
    left = F.count("*").over(own) - rank
    kept = postings.withColumn("left", left).filter(F.col("left") + 1 >= _least_shared(F.col("n"), similarity, FINE))
    # Linked sets differ in size by at most the threshold: their bands are equal or next to each other.
    band = F.floor(F.log("n") / F.log(F.lit(1 / (similarity - 0.001)))).cast("int")
    return kept.select("c", "n", "v", "left", band.alias("band"))


def _fits(a: Column, b: Column, similarity: float) -> Column:
    return F.least(a, b) >= F.lit(similarity) * F.greatest(a, b) - 1e-9


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _meet(n1: Column, left1: Column, n2: Column, left2: Column, similarity: float) -> Column:
    """Whether a common value at these places can be the first one of linked sets."""
    both_whole = F.greatest(n1, n2) <= FINE
    whole = F.ceil((n1 + n2) * F.lit(similarity / (1 + similarity)) - 1e-9)
    cut = F.greatest(_least_shared(n1, similarity, FINE), _least_shared(n2, similarity, FINE))
    return _fits(n1, n2, similarity) & (F.least(left1, left2) + 1 >= F.when(both_whole, whole).otherwise(cut))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches leave it open and whose full sets agree."""
    a = sets.select(F.col("c").alias("a"), F.col("set").alias("sa"))
    b = sets.select(F.col("c").alias("b"), F.col("set").alias("sb"))
    both = pairs.join(a, "a").join(b, "b")
    low = lambda name: F.slice(name, 1, SKETCH)
    union = F.slice(F.sort_array(F.array_union(low("sa"), low("sb"))), 1, SKETCH)
    hit = F.size(F.array_intersect(union, F.array_intersect(low("sa"), low("sb"))))
    floor = F.when(F.size(union) < SKETCH, F.ceil(F.size(union) * F.lit(percent / 100) - 1e-9)).otherwise(needed(percent / 100))
    shared = F.size(F.array_intersect("sa", "sb")).cast("long")
    alike = 100 * shared >= percent * (F.size("sa").cast("long") + F.size("sb") - shared)
    return stored(both.filter(F.when(hit >= floor, alike).otherwise(False)).select("a", "b"), "links")


def _star_pairs(lists: DataFrame, turn: int, similarity: float) -> DataFrame:
    """Each class with the few leaders of another component it meets in most lists.

    Leaders are by turns the class of a list that shares most of its values with
    others, as the text does that many were copied from, and one of a random component.
    """
    shared = F.count("*").over(Window.partitionBy("c")) / F.col("n") if turn % 2 == 0 else F.lit(0.0)
    lists = lists.withColumn("shared", -shared)
    draw = F.struct("shared", F.xxhash64(F.lit(turn), "label", "v").alias("draw"), "c", "n", "left", "label")
    leaders = lists.groupBy("v", "band").agg(F.min(draw).alias("leader"))
    asked = lists.withColumn("band", F.explode(F.array(F.col("band"), F.col("band") - 1)))
    near = _meet(F.col("n"), F.col("left"), F.col("leader.n"), F.col("leader.left"), similarity)
    met = asked.join(leaders, ["v", "band"]).filter((F.col("label") != F.col("leader.label")) & near)
    counted = met.groupBy(F.col("c").alias("x"), F.col("leader.c").alias("y")).agg(F.count("*").alias("met"))
    best = F.row_number().over(Window.partitionBy("x").orderBy(F.desc("met"), "y"))
    return _ordered(counted.withColumn("best", best).filter(F.col("best") <= LEADERS))


def _ahead(lists: DataFrame) -> int:
    """How many pairs of different components the lists hold, counted from sums and not from pairs."""
    sides = stored(lists.groupBy("v", "band", "label").agg(F.count("*").alias("m")), "sides")
    totals = sides.groupBy("v", "band").agg(F.sum("m").alias("n"), F.sum(F.col("m") * F.col("m")).alias("own"))
    below = totals.select("v", (F.col("band") + 1).alias("band"), F.col("n").alias("n2"))
    counted = totals.join(below, ["v", "band"], "left")
    every = counted.agg(F.sum((F.col("n") * F.col("n") - F.col("own")) / 2 + F.col("n") * F.coalesce("n2", F.lit(0)))).first()[0]
    lower = sides.select("v", "label", (F.col("band") + 1).alias("band"), F.col("m").alias("m2"))
    same = sides.join(lower, ["v", "label", "band"]).agg(F.sum(F.col("m") * F.col("m2"))).first()[0]
    return int((every or 0) - (same or 0))


def _cross_pairs(lists: DataFrame, similarity: float) -> DataFrame:
    """All pairs of classes of different components that can be linked by what their lists tell.

    A pair is met in the list of its first common value only: every entry has
    the class's values that come earlier (no more than its prefix is long), and
    entries with one of those in common met before. The conditions are hardest
    to meet further on, so nothing is lost.
    """
    before = Window.partitionBy("c").orderBy(F.desc("left")).rowsBetween(Window.unboundedPreceding, -1)
    lists = lists.withColumn("earlier", F.collect_list("v").over(before))
    one = lists.select(
        "v",
        F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"),
        F.col("label").alias("l1"),
        F.col("c").alias("x"),
        F.col("n").alias("n1"),
        F.col("left").alias("left1"),
        F.col("earlier").alias("e1"),
    )
    two = lists.select(
        "v", "band", F.col("label").alias("l2"), F.col("c").alias("y"), F.col("n").alias("n2"), F.col("left").alias("left2"), F.col("earlier").alias("e2")
    )
    # The smaller set, or of equal sizes the smaller class, is on the left, so a pair meets once in a list.
    ordered = (F.col("n1") < F.col("n2")) | ((F.col("n1") == F.col("n2")) & (F.col("x") < F.col("y")))
    # As the other set is no smaller, more of the values of this one must follow.
    share = 2 * similarity / (1 + similarity)
    far = F.when(F.col("n1") <= FINE, F.least(F.ceil(F.col("n1") * F.lit(share) - 1e-9), F.lit(needed(similarity, FINE))))
    one = one.filter(F.col("left1") + 1 >= F.coalesce(far, F.lit(needed(similarity, FINE))))
    near = _meet(F.col("n1"), F.col("left1"), F.col("n2"), F.col("left2"), similarity)
    met = one.join(two, (one["v"] == two["v"]) & (one["band"] == two["band"]) & (F.col("l1") != F.col("l2")) & ordered & near & ~F.arrays_overlap("e1", "e2"))
    return _ordered(met)


def _labelled(lists: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return lists.withColumn("label", F.col("c"))
    named = labels.select(F.col("node").alias("c"), F.col("label").alias("named"))
    return lists.join(named, "c", "left").withColumn("label", F.coalesce("named", "c")).drop("named")


def _links(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame | None:
    """Links (a, b) between classes that join all classes which belong together; None if there are none."""
    similarity = percent / 100
    coarse = classes.filter("n > 0").select("c", "n", F.explode("sketch").alias("v"))
    members = stored(_shared(coarse, similarity, SKETCH).select("c").distinct(), "members")
    n_members = members.count()
    if not n_members:
        return None
    chosen = classes.join(members, "c", "left_semi").select("c", "rep.*")
    sent = F.broadcast(chosen) if n_members <= BROADCAST_IDS else chosen
    source = keyed(docs, "doc_id", "text")
    texts = source.join(sent, same_key(source, sent)).select("c", "text")
    sets = stored(texts.select("c", shingles(F.col("text"), size).alias("set")).dropDuplicates(["c"]), "sets")
    fine = sets.select("c", F.size("set").alias("n"), F.explode(F.slice("set", 1, FINE)).alias("v"))
    lists = stored(_prefix(_shared(fine, similarity, FINE), similarity), "lists")
    links, labels, turn, before = None, None, 0, None
    while True:
        named = stored(_labelled(lists, labels), "named-lists")
        mixed = named.groupBy("v").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
        named = named.join(mixed.select("v"), "v", "left_semi")
        ahead = _ahead(named)
        if not ahead:
            return links
        last = ahead <= PAIRS_PER_CLASS * n_members or (before is not None and ahead > WORTHWHILE * before)
        pairs = _cross_pairs(named, similarity) if last else _star_pairs(named, turn, similarity)
        new = _linked(pairs, sets, percent)
        links = new if links is None else links.union(new)
        if last:
            return links
        labels, turn, before = components(links), turn + 1, ahead


def _groups(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Per row its key, class and set size; and of every class in a group of several rows the group's first row, no_id, k_id, k_text."""
    rows = stored(signatures(docs, size), "signatures")
    rep = F.min(F.struct(F.col("k_id").isNull().alias("no_id"), "k_id", "k_text"))
    grouped = rows.filter("n > 0").groupBy("c").agg(rep.alias("first"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.count("*").alias("copies"))
    classes = stored(grouped.withColumn("rep", F.struct("first.k_id", "first.k_text")), "classes")
    links = _links(docs, classes, size, percent)
    named = _labelled(classes.select("c", "first", "copies"), None if links is None else components(links))
    first = named.groupBy("label").agg(F.min("first").alias("of_group"), F.sum("copies").alias("copies")).filter("copies > 1")
    return rows.select(*KEY, "c", "n"), named.select("c", "label").join(first, "label").select("c", "of_group")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its key, n_shingles, component_id (the smallest id of its group) and kept.

    Documents are linked if 100 * |intersection| >= percent * |union|.
    """
    rows, groups = _groups(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), size, percent)
    component = F.coalesce("of_group.k_id", "k_id")
    return rows.join(groups, "c", "left").select(
        *KEY, F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"), F.col("k_id").eqNullSafe(component).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group, with all its columns.

    It is a row with the smallest id (null if all are) and of those the one with
    the smallest hash of its text, then of all its columns, so rows that repeat
    id and text, or have no id, leave one too. A document without words is in no
    group and stays.
    """
    rows, groups = _groups(docs.select("doc_id", "text"), size, percent)
    first = F.struct(F.col("k_id").isNull().alias("no_id"), *KEY).eqNullSafe(F.col("of_group"))
    fates = rows.filter("n > 0").join(groups, "c").select(*KEY, first.alias("stays")).distinct()
    row = keyed(docs, "doc_id", "text", F.struct("*").alias("row"))
    judged = row.join(fates, same_key(row, fates), "left").select(row["k_id"], row["k_text"], "row", "stays")
    # Repeats of one row are combined in every task before they meet.
    one = judged.filter("stays").groupBy(*KEY).agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return judged.filter("stays IS NULL").select("row.*").unionByName(one.select("row.*"))
