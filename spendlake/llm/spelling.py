"""Spelling variants: words one letter apart, found in a trie of letter-group counts.

A word's counts of successive letter groups are its path in a trie. Two words
that differ by one inserted, deleted or replaced code point have the same counts
but for a surplus of one in at most one group and a deficit of one in at most
one group. So a depth-first search that may spend one surplus and one deficit
meets every near word in a leaf; the words of a leaf are verified.

The top of the trie (nodes that hold more than ``LEAF_WORDS`` words) is walked
to deal words and searches to sub-tries; each sub-trie is searched in one task.
A pair is met once: from the longer word, or on the path that spends its surplus
before its deficit, or from the smaller word of one leaf.

A leaf is not compared pair by pair: an edit leaves the first or the second half
of a word as it is, so the words of a leaf are looked up by either half.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.text import stored

MIN_LENGTH = 7
MIN_COUNT = 2
# A form is at least so many times as frequent as its variant.
RATIO = 10
# Words of a run of ids are miswritten in one run of ``SLIPS``.
SLIPS = 31
# Letter groups in the order of the trie's levels; all other characters are one more group.
GROUPS = ("e", "t", "a", "n", "o", "r", "i", "h", "s", "d", "l", "u", "c", "fgp", "mbv", "wjkqxyz", "éèêëáàâä")
LEAF_WORDS = 20_000
# Sub-tries that hold the same full counts and are still too large are dealt out by hash.
# States of the search: what was spent so far.
NOTHING, SURPLUS, DEFICIT, BOTH = range(4)
# Search states expanded at once in a task, and counts a task keeps before it hands them on.
CHUNK = 400_000
HELD_COUNTS = 300_000

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
_LEVEL = {ord(letter): n for n, group in enumerate(GROUPS) for letter in group}
_LEVELS = np.array([_LEVEL.get(c, len(GROUPS)) for c in range(256)])
DEPTH = len(GROUPS) + 1


def runs(text: str) -> list[bytes]:
    """The letter runs of a text in Latin-1, A-Z in lower case; other characters only separate."""
    return text.encode("latin-1", "replace").translate(_FOLD).split()


def written(doc_id: object, run: bytes) -> bytes:
    """The run as the document spells it: one in ``SLIPS`` loses a letter, as the checksum of id and run decides."""
    prefix = f"{'' if doc_id is None else doc_id}:".encode()
    h = zlib.crc32(run.decode("latin-1").encode(), zlib.crc32(prefix))
    if h % SLIPS:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): every word of at least ``MIN_LENGTH`` letters met at least ``MIN_COUNT`` times."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed() -> pa.RecordBatch:
            words = [word.decode("latin-1") for word in total]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        total: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = Counter(run for run in runs(text.as_py()) if len(run) >= MIN_LENGTH)
                for run, n in own.items():
                    word = written(doc_id, run)
                    if len(word) >= MIN_LENGTH:
                        total[word] += n
                if len(total) > HELD_COUNTS:
                    yield handed()
                    total.clear()
        yield handed()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    partial = rows.mapInArrow(count, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def counts(words: list[bytes]) -> np.ndarray:
    """The letter-group counts of every word, one row each."""
    lengths = np.array([len(word) for word in words], dtype=np.int64)
    row = np.repeat(np.arange(len(words)), lengths)
    level = _LEVELS[np.frombuffer(b"".join(words), dtype=np.uint8)]
    return np.bincount(row * DEPTH + level, minlength=len(words) * DEPTH).reshape(len(words), DEPTH).astype(np.int64)


class Trie:
    """Distinct rows of counts as a trie; children of a level are found by (node, count) in a sorted array."""

    def __init__(self, rows: np.ndarray):
        """``rows`` are distinct and in order; a path ends at a count of -1 or with the row."""
        self.base = int(rows.max(initial=0)) + 1
        self.keys, self.ends = [], []
        node = np.zeros(len(rows), dtype=np.int64)
        alive = np.arange(len(rows))
        for level in range(rows.shape[1]):
            alive = alive[rows[alive, level] >= 0]
            if not len(alive):
                break
            key = node[alive] * self.base + rows[alive, level]
            found, node_of = np.unique(key, return_inverse=True)
            node[alive] = node_of
            last = np.full(len(found), -1)
            ended = alive[rows[alive, level + 1] < 0] if level + 1 < rows.shape[1] else alive
            last[node[ended]] = ended
            self.keys.append(found)
            self.ends.append(last)

    def search(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, row, what was spent) of every path's end that the budget reaches, in pieces; deepest pieces first."""
        start = np.arange(len(queries))
        stack = [(0, start, np.zeros_like(start), np.full(len(start), NOTHING))] if self.keys and len(start) else []
        while stack:
            level, query, node, state = stack.pop()
            if len(query) > CHUNK:
                half = len(query) // 2
                stack += [(level, query[half:], node[half:], state[half:]), (level, query[:half], node[:half], state[:half])]
                continue
            own = queries[query, level]
            more, less, rest = state == NOTHING, (state == NOTHING) & (own > 0), (state == SURPLUS) & (own > 0)
            take = [slice(None), more, less, rest]
            query2 = np.concatenate([query[t] for t in take])
            tried = np.concatenate([own[t] + step for t, step in zip(take, (0, 1, -1, -1))])
            key = np.concatenate([node[t] for t in take]) * self.base + tried
            state2 = np.concatenate([state, np.full(more.sum(), SURPLUS), np.full(less.sum(), DEFICIT), np.full(rest.sum(), BOTH)])
            child = np.searchsorted(self.keys[level], key)
            child[child == len(self.keys[level])] = 0
            real = (self.keys[level][child] == key) & (tried < self.base)
            query2, child, state2 = query2[real], child[real], state2[real]
            row = self.ends[level][child]
            ended = row >= 0
            if ended.any():
                yield query2[ended], row[ended], state2[ended]
            on = ~ended
            if on.any() and level + 1 < len(self.keys):
                stack.append((level + 1, query2[on], child[on], state2[on]))


@dataclass(frozen=True)
class Top:
    """The upper trie: its leaves (paths padded with -1), and into how many parts the words of each are dealt."""

    paths: np.ndarray
    parts: np.ndarray


def top_of(paths: DataFrame, leaf_words: int) -> Top:
    """Nodes are split level by level while they hold more than ``leaf_words`` words.

    Only split nodes' children come to the driver: at most about one node for
    every ``leaf_words`` words and level, times the different counts of a group.
    """
    leaves: list[tuple[tuple[int, ...], int]] = []
    inner: list[tuple[int, ...]] = [()]
    for level in range(1, DEPTH + 1):
        prefix = F.slice("path", 1, level)
        rows = paths
        if level > 1:
            names = paths.sparkSession.createDataFrame([(list(path),) for path in inner], "up array<long>")
            rows = paths.join(F.broadcast(names), F.slice("path", 1, level - 1) == F.col("up"), "left_semi")
        sizes = [(tuple(row.node), row.n) for row in rows.groupBy(prefix.alias("node")).agg(F.count("*").alias("n")).collect()]
        full = {node for node, n in sizes if n > leaf_words} if level < DEPTH else set()
        leaves += [(node, n) for node, n in sizes if node not in full]
        inner = sorted(full)
        if not inner:
            break
    leaves.sort()
    padded = np.array([[*node, *[-1] * (DEPTH - len(node))] for node, _ in leaves], dtype=np.int64).reshape(len(leaves), DEPTH)
    return Top(padded, np.array([-(-n // leaf_words) for _, n in leaves], dtype=np.int64))


ROUTED = "leaf long, part int, asks boolean, word binary, n long"


def routed(words: DataFrame, top: Top) -> DataFrame:
    """Every word in the sub-trie where it lives, and (``asks``) in all sub-tries that its search enters, its own included."""
    shared = words.sparkSession.sparkContext.broadcast(top)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = shared.value
        trie = Trie(top.paths)
        for batch in batches:
            own = [word.encode("latin-1") for word in batch.column(0).to_pylist()]
            if not own:
                continue
            n = batch.column(1).to_numpy()
            distinct, of = np.unique(counts(own), axis=0, return_inverse=True)
            of = of.ravel()
            order, first = np.argsort(of, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(of))])
            share = np.array([zlib.crc32(word) for word in own])
            for query, leaf, state in trie.search(distinct):
                size = (first[1:] - first[:-1])[query]
                word = order[_spans(first[query], size)]
                leaf, home = np.repeat(leaf, size), np.repeat(state, size) == NOTHING
                yield _routed_rows(leaf[home], share[word[home]] % top.parts[leaf[home]], False, word[home], own, n)
                parts = top.parts[leaf]
                yield _routed_rows(np.repeat(leaf, parts), _spans(np.zeros_like(parts), parts), True, np.repeat(word, parts), own, n)

    return words.select("word", "n").mapInArrow(route, ROUTED)


def _routed_rows(leaf: np.ndarray, part: np.ndarray, asks: bool, word: np.ndarray, own: list[bytes], n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(leaf, pa.int64()),
            pa.array(part.astype(np.int32)),
            pa.array(np.full(len(leaf), asks)),
            pa.array([own[i] for i in word], pa.binary()),
            pa.array(n[word], pa.int64()),
        ],
        names=["leaf", "part", "asks", "word", "n"],
    )


def _spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for every span, one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size - first, size)


def is_near(a: bytes, b: bytes) -> bool:
    """Whether exactly one code point is inserted, deleted or replaced."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) > len(b) + 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[at + 1 :] == (b[at + 1 :] if len(a) == len(b) else b[at:])


def _verified(searching: list[bytes], found: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``is_near`` for the pairs (searching[a], found[b]), where the first is as long or one longer."""
    near = np.zeros(len(a), dtype=bool)
    lengths, others = np.array([len(w) for w in searching]), np.array([len(w) for w in found])
    short = lengths[a] <= 32
    for i in np.flatnonzero(~short):
        near[i] = is_near(searching[a[i]], found[b[i]])
    rows = np.flatnonzero(short)
    wide, narrow = _matrix(searching), _matrix(found)
    for start in range(0, len(rows), CHUNK):
        some = rows[start : start + CHUNK]
        x, y = wide[a[some]], narrow[b[some]]
        differ = x != y
        at = np.where(differ.any(axis=1), differ.argmax(axis=1), 33)
        replaced = (lengths[a[some]] == others[b[some]]) & (differ.sum(axis=1) == 1)
        # With one letter more, what follows the first difference is the same one place on.
        later = (x[:, 1:] != y[:, :-1]) & (np.arange(32) >= at[:, None])
        longer = (lengths[a[some]] == others[b[some]] + 1) & ~later.any(axis=1)
        near[some] = replaced | longer
    return near


def _matrix(words: list[bytes]) -> np.ndarray:
    """The first 33 letters of every word, padded with zeros."""
    return np.array([word[:33] for word in words], dtype="S33").view(np.uint8).reshape(len(words), 33)


def _halves(words: list[bytes], skip: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of both halves; with ``skip`` one letter is left out between them, as if it were deleted."""
    half = [(len(word) - skip) // 2 for word in words]
    return (
        np.array([hash(word[:h]) for word, h in zip(words, half)], dtype=np.int64),
        np.array([hash(word[h + skip :]) for word, h in zip(words, half)], dtype=np.int64),
    )


def _look_up(keys: np.ndarray, order: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``wanted``, word) for every word whose key is wanted; ``keys`` are in order."""
    low, high = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
    size = high - low
    return np.repeat(np.arange(len(wanted)), size), order[_spans(low, size)]


def _mixed(row: np.ndarray, half: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return half ^ (row.astype(np.int64) * np.int64(-7046029254386353131))


def near_pairs(homes: list[bytes], searching: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place in ``searching``, place in ``homes``) of near words, each pair once."""
    if not homes or not searching:
        return
    paths, row_of = np.unique(counts(homes), axis=0, return_inverse=True)
    row_of = row_of.ravel()
    trie = Trie(paths)
    asked, of = np.unique(counts(searching), axis=0, return_inverse=True)
    of = of.ravel()
    by_asked, first = np.argsort(of, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(of))])
    home_halves, sides = _halves(homes, 0), []
    for half in home_halves:
        key = _mixed(row_of, half)
        order = np.argsort(key, kind="stable")
        sides.append((key[order], order))
    own = {skip: _halves(searching, skip) for skip in (0, 1)}
    for query, row, state in trie.search(asked):
        # A surplus without a deficit is a longer word, which meets this one by its own search.
        some = state != SURPLUS
        query, row, state = query[some], row[some], state[some]
        size = (first[1:] - first[:-1])[query]
        word, row, state = by_asked[_spans(first[query], size)], np.repeat(row, size), np.repeat(state, size)
        for shorter in (False, True):
            mine = (state == DEFICIT) == shorter
            if not mine.any():
                continue
            halves = own[int(shorter)]
            for side in (0, 1):
                at, other = _look_up(*sides[side], _mixed(row[mine], halves[side][word[mine]]))
                one, st = word[mine][at], state[mine][at]
                # What both halves meet is taken from the first.
                keep = np.full(len(one), side == 0) | (halves[0][one] != home_halves[0][other])
                one, other, st = one[keep], other[keep], st[keep]
                good = _verified(searching, homes, one, other)
                one, other, st = one[good], other[good], st[good]
                if len(one):
                    smaller = np.array([s != NOTHING or searching[i] < homes[j] for i, j, s in zip(one, other, st)])
                    if smaller.any():
                        yield one[smaller], other[smaller]


NEAR = "word string, n long, n_near long, best_n long, best string"


def _near_rows(rows: pd.DataFrame) -> pd.DataFrame:
    """Per word of a sub-trie: how many near words were met here and the best of them."""
    asks = rows["asks"].to_numpy(dtype=bool)
    homes, asking = rows[~asks], rows[asks]
    home_words, ask_words = list(homes["word"]), list(asking["word"])
    home_n, ask_n = homes["n"].to_numpy(), asking["n"].to_numpy()
    best: dict[bytes, list] = {}

    def meet(word: bytes, n: int, other: bytes, other_n: int) -> None:
        held = best.get(word)
        if held is None:
            best[word] = [n, 1, other_n, other]
            return
        held[1] += 1
        if other_n > held[2] or (other_n == held[2] and other < held[3]):
            held[2], held[3] = other_n, other

    for one, other in near_pairs(home_words, ask_words):
        for i, j in zip(one.tolist(), other.tolist()):
            a, b, na, nb = ask_words[i], home_words[j], int(ask_n[i]), int(home_n[j])
            meet(a, na, b, nb)
            meet(b, nb, a, na)
    out = [(word.decode("latin-1"), n, met, other_n, other.decode("latin-1")) for word, (n, met, other_n, other) in best.items()]
    return pd.DataFrame(out, columns=["word", "n", "n_near", "best_n", "best"])


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words with a form; each turn doubles the steps taken. Frequencies rise tenfold a step, so it ends."""
    steps = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = stored(steps.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if steps.filter("moved").isEmpty():
            return steps.select("word", "root")
        steps = steps.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", leaf_words: int = LEAF_WORDS) -> DataFrame:
    """(word, n, form, root, n_near, form_n) of every word of the corpus.

    Null and empty texts hold no word; a null id counts as empty text where the
    id decides a spelling; repeated rows count as often as they occur. Of near
    words equally frequent the smallest is the form. No documents give no rows.
    Words of any length are compared whole. Only the two named columns are read,
    so further columns, whatever their names, have no effect.
    """
    words = stored(vocabulary(docs, id_col, text_col), "words")
    paths = stored(words.select(_path(F.col("word")).alias("path")), "paths")
    top = top_of(paths, leaf_words)
    met = routed(words, top).groupBy("leaf", "part").applyInPandas(_near_rows, NEAR)
    order = F.struct((-F.col("best_n")).alias("order"), F.col("best").alias("word"), F.col("best_n").alias("n"))
    near = met.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(order).alias("best"))
    is_form = F.col("best.n") >= RATIO * F.col("n")
    judged = stored(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.word")).alias("form"),
            F.when(is_form, F.col("best.n")).alias("form_n"),
        ),
        "variants",
    )
    roots = _roots(judged.filter("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")


def _path(word: Column) -> Column:
    """The letter-group counts of a word as an array, as ``counts`` gives them."""
    known = [F.length(word) - F.length(F.translate(word, group, "")) for group in GROUPS]
    rest = F.length(F.translate(word, "".join(GROUPS), ""))
    return F.array(*[c.cast("long") for c in known], rest.cast("long"))
