"""Language-model scores from a hashed maximum-entropy model.

log P(text) is the sum over its words and its end of log P(word | history). The
words are the leaves of a tree of classes, in which a node has up to ``WIDTH``
sub-classes: P(word | history) is the product of the softmax of every node on
the way. Each of them has hashed features of the history: the previous word, the
one before it (a skip), both together, and the coarse classes of both; a row of
the weight table belongs to a feature and a node. So the history chooses between
all words of the tree. Without features a node gives its sub-classes their
relative frequency. The tree is a Huffman tree: frequent words are near its root.

The tree has the ``HEAD`` most frequent words and ``ENDINGS`` leaves for the
training words outside of the head, by hashed ending. Within such a leaf a word
has its relative frequency. A discount of all counts goes to the words unseen in
training, one word per ending, without history.

Weights are fitted by distributed gradient updates. Training documents are turned
into leaf numbers once and dealt by hash into buckets of about ``BUCKET_TOKENS``
tokens. In every round each bucket starts from the same weights and runs Adagrad
over its documents in the order of their hashes; the rows of the weight table are
averaged, each weighted by how often a bucket saw the feature. The buckets depend
on the documents alone, so scores do not depend on files, partitions or cluster.
All training documents take part in every round. Texts are scored whole in
numpy batches.

The counts are a table. The ``HEAD`` most frequent words of it go to every
task; for all other words of a document the table is joined, once per document
and word, so the vocabulary may be of any size.

Defined results: a null or empty text is its end alone; without training
documents every count is zero and every ending equally likely; equal counts are
ordered by word; rows are scored one by one, and rows that repeat id and text
have the same score (in training they are one document that counts as often);
further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import groupby
from zlib import compress, crc32, decompress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.text import KEY, keyed, stored

SINGLE = 63
ENDINGS = 64
WIDTH = 16
ROW_BITS = 18
ROWS = 1 << ROW_BITS
LINE = np.dtype((np.void, 4 * WIDTH))
HEAD = 200_000
ROUNDS = 2
BUCKET_TOKENS = 2_000_000
# Ranges of the weight table that are summed apart.
SHARDS = 64
# Text that is split into words at once, unless a single text is longer, and tokens that are trained at once.
PIECE_BYTES = 2_000_000
CHUNK_TOKENS = 50_000
RATE = 0.25
BATCH = 1_024
DISCOUNT = 0.5
END = b""
# Odd multipliers that spread two 32-bit hashes over the rows.
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def split(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Tokens per text, its end included, and the words of all texts in lower case (A-Z)."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, parents = words.flatten(), pc.list_parent_indices(words)
    kept = pc.greater(pc.binary_length(flat), 0)
    lengths = np.bincount(parents.filter(kept).to_numpy(zero_copy_only=False), minlength=len(texts))
    return lengths + 1, flat.filter(kept)


def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in pieces of bounded text."""
    for batch in batches:
        size = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)) // PIECE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(size)) + 1), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            if stop > start:
                yield batch.slice(start, stop - start)


def ending(word: bytes) -> int:
    return SINGLE + crc32(word[-2:]) % ENDINGS


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c) over keyed documents, as binary words; summed per piece before anything is moved."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            lengths, words = split(piece.column("text"))
            found = words.value_counts()
            own = found.field("values").cast(pa.binary()), found.field("counts").cast(pa.int64())
            yield pa.RecordBatch.from_arrays(list(own), names=["word", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([len(lengths)], pa.int64())], names=["word", "n"])

    return docs.select("text").mapInArrow(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


@dataclass(frozen=True)
class Head:
    """The most frequent words: their counts by falling count, the totals of all words, and the tree."""

    words: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int
    # By ending: tokens of the words outside the head, and distinct words.
    rare_tokens: np.ndarray
    ending_words: np.ndarray
    # The way to leaf n is steps starts[n] to starts[n + 1]; leaves are the words and then the endings.
    starts: np.ndarray
    nodes: np.ndarray
    branches: np.ndarray
    # log of the share of every sub-class of a node.
    bias: np.ndarray

    def classes(self) -> np.ndarray:
        return np.array([n if n < SINGLE else ending(word) for n, word in enumerate(self.words)], dtype=np.int64)

    def unseen(self) -> float:
        """The probability of all words unseen in training."""
        return DISCOUNT * self.distinct / self.total if self.total else 1.0


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """starts, nodes, branches and bias of the tree over these leaves."""
    leaves = len(counts)
    heap = [(float(c), n) for n, c in enumerate(counts)]
    heapify(heap)
    # Only the first node may have fewer sub-classes.
    take = 2 + (leaves - 2) % (WIDTH - 1)
    up, branch, bias = [-1] * leaves, [0] * leaves, []
    while len(heap) > 1:
        below = [heappop(heap) for _ in range(take)]
        weight = sum(c for c, _ in below)
        for place, (_, child) in enumerate(below):
            up[child], branch[child] = len(bias), place
        heappush(heap, (weight, leaves + len(bias)))
        bias.append([math.log(c / weight) for c, _ in below] + [-50.0] * (WIDTH - take))
        up.append(-1)
        branch.append(0)
        take = WIDTH
    up, branch, at, ways = np.array(up), np.array(branch), np.arange(leaves), []
    while (up[at] >= 0).any():
        ways.append((up[at], branch[at]))
        at = np.where(up[at] >= 0, leaves + up[at], at)
    nodes, branches = (np.stack(side, axis=1) for side in zip(*ways))
    on = nodes >= 0
    starts = np.concatenate([[0], np.cumsum(on.sum(axis=1))])
    return starts, nodes[on].astype(np.int32), branches[on].astype(np.int8), np.array(bias, dtype=np.float32)


def vocabulary_head(vocabulary: DataFrame) -> Head:
    # Counts to three digits: a bounded histogram tells from which count on the words fit into the head.
    digits = F.greatest(F.floor(F.log10(F.col("c"))) - 2, F.lit(0))
    least = (F.floor(F.col("c") / F.pow(F.lit(10.0), digits)) * F.pow(F.lit(10.0), digits)).cast("long")
    bins = sorted(((r.least, r.n) for r in vocabulary.groupBy(least.alias("least")).agg(F.count("*").alias("n")).collect()), reverse=True)
    taken, held = F.lit(False), 0
    for low, n in bins:
        if held + n > HEAD:
            # Of words about as frequent as each other, those with the smallest hashes fill what is left.
            place = F.shiftrightunsigned(F.xxhash64("word"), 48)
            alike, cut = least == low, 0
            for at, m in sorted((r.at, r.m) for r in vocabulary.filter(alike).groupBy(place.alias("at")).agg(F.count("*").alias("m")).collect()):
                held += m
                if held > HEAD:
                    break
                cut = at + 1
            taken = taken | (alike & (place < cut))
            break
        held += n
        taken = F.col("c") >= low
    frequent = vocabulary.filter(taken)
    found = frequent.select("word", "c").toArrow()
    rows = sorted(zip(found["word"].to_pylist(), found["c"].to_pylist()), key=lambda r: (-r[1], r[0]))
    words, counts = [word for word, _ in rows], np.array([c for _, c in rows], dtype=np.float64)
    by_end = vocabulary.groupBy((F.crc32(F.expr("substring(word, -2, 2)")) % ENDINGS).alias("e"))
    sums = {r.e: (r.c, r.n) for r in by_end.agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()}
    total, distinct = sum(c for c, _ in sums.values()), sum(n for _, n in sums.values())
    rare_tokens, ending_words = np.zeros(ENDINGS), np.zeros(ENDINGS)
    for e, (c, n) in sums.items():
        rare_tokens[e], ending_words[e] = c, n
    for word, c in zip(words, counts):
        rare_tokens[ending(word) - SINGLE] -= c
    tree = huffman(np.concatenate([counts, np.maximum(rare_tokens, DISCOUNT)]))
    return Head(words, counts, total, distinct, rare_tokens, ending_words, *tree)


@dataclass(frozen=True)
class Tokens:
    """Texts as arrays: lengths; the distinct words and their numbers in the head (or -1); by token its word, leaf and history."""

    lengths: np.ndarray
    words: pa.Array
    ids: np.ndarray
    which: np.ndarray
    leaves: np.ndarray
    classes: np.ndarray
    hashes: np.ndarray

    def history(self) -> np.ndarray:
        return features(self.classes, self.hashes, places(self.lengths))


def places(lengths: np.ndarray) -> np.ndarray:
    """The position of every token in its text."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


class Reader:
    """Turns texts into arrays with the words of the head."""

    def __init__(self, head: Head):
        self.head = head
        self.words = pa.array(head.words, pa.large_binary())
        # By leaf; for words outside the head the hash is their own.
        self.classes = np.concatenate([head.classes(), SINGLE + np.arange(ENDINGS)])
        self.hashes = np.array([crc32(word) for word in head.words] + [0] * ENDINGS, dtype=np.uint64)

    def shared(self) -> dict:
        """What a broadcast holds, so that a task need not go through the words again."""
        return {**vars(self), "head": vars(self.head)}

    @classmethod
    def of(cls, shared: dict) -> Reader:
        reader = cls.__new__(cls)
        vars(reader).update(shared, head=Head(**shared["head"]))
        return reader

    def read(self, texts: pa.Array) -> Tokens:
        lengths, flat = split(texts)
        coded = flat.dictionary_encode()
        words = pa.concat_arrays([coded.dictionary.cast(pa.large_binary()), pa.array([END], pa.large_binary())])
        which = np.full(lengths.sum(), len(words) - 1)
        inner = np.ones(len(which), dtype=bool)
        inner[np.cumsum(lengths) - 1] = False
        which[inner] = coded.indices.to_numpy()
        ids = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        rare = np.flatnonzero(ids < 0)
        own = words.take(pa.array(rare)).to_pylist()
        leaves = ids.copy()
        leaves[rare] = [len(self.words) + ending(word) - SINGLE for word in own]
        hashes = self.hashes[leaves]
        hashes[rare] = [crc32(word) for word in own]
        return Tokens(lengths, words, ids, which, leaves[which], self.classes[leaves][which], hashes[which])


def features(classes: np.ndarray, hashes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The hashed features of the history of every token. ``place``: position in its text."""

    def back(values: np.ndarray, steps: int) -> np.ndarray:
        shifted = np.zeros(len(values), dtype=np.uint64)
        shifted[steps:] = values[:-steps].astype(np.uint64) + np.uint64(1)
        shifted[place < steps] = 0
        return shifted

    def mix(a: np.ndarray, b: np.ndarray | int, kind: int) -> np.ndarray:
        mixed = (a * MIX[0]) ^ (np.uint64(b) if isinstance(b, int) else b * MIX[1]) ^ np.uint64(kind * 0x51ED270B)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX[1]
        return mixed ^ (mixed >> np.uint64(32))

    h1, h2, c1, c2 = back(hashes, 1), back(hashes, 2), back(classes, 1), back(classes, 2)
    # One feature after the other in memory, as the steps read them.
    return np.stack([mix(h1, 0, 1), mix(h2, 0, 2), mix(h1, h2, 3), mix(c1, c2, 4)]).T


def steps(head: Head, leaves: np.ndarray, history: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches of the steps down the tree: token, node, branch taken, and by feature the row of the weight table."""
    spread = (np.arange(len(head.bias), dtype=np.uint64) + np.uint64(1)) * MIX[1]
    for first in range(0, len(leaves), BATCH):
        own = leaves[first : first + BATCH]
        start, length = head.starts[own], head.starts[own + 1] - head.starts[own]
        token = np.repeat(np.arange(len(own)), length)
        at = np.arange(len(token)) + np.repeat(start - np.cumsum(length) + length, length)
        node = head.nodes[at]
        mixed = np.take(history[first : first + BATCH].T, token, axis=1)
        mixed ^= spread[node]
        mixed *= MIX[0]
        mixed >>= np.uint64(64 - ROW_BITS)
        yield first + token, node, head.branches[at], mixed.astype(np.int64)


def logits(weights: np.ndarray, bias: np.ndarray, node: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = np.take(bias, node, axis=0)
    for own in rows:
        out += np.take(weights, own, axis=0)
    return out


def taken(branch: np.ndarray) -> np.ndarray:
    """Where the branches taken are in a flat array of (step, branch)."""
    return np.arange(len(branch)) * WIDTH + branch


def leaf_scores(weights: np.ndarray, head: Head, leaves: np.ndarray, history: np.ndarray) -> np.ndarray:
    """log10 P(leaf | history) of every token, in batches that stay in the cache."""
    found = np.zeros(len(leaves))
    for token, node, branch, rows in steps(head, leaves, history):
        z = logits(weights, head.bias, node, rows)
        own = z.reshape(-1)[taken(branch)]
        np.exp(z, out=z)
        first = token[0]
        sums = np.bincount(token - first, weights=own - np.log(z.sum(axis=1)))
        found[first : first + len(sums)] = sums
    return found / math.log(10)


def fit(weights: np.ndarray, head: Head, chunks: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Adagrad, one rate per row, over (leaves, histories, times): the new weights and how often each row was seen."""
    weights, squares, seen = weights.copy(), np.full(ROWS, 1e-2, dtype=np.float32), np.zeros(ROWS)
    # A row as one item is copied as a whole, and two lanes as one complex number are added at once.
    lines, pairs = weights.view(LINE).reshape(-1), np.arange(WIDTH // 2)
    for leaves, history, times in chunks:
        met, often, once = [], [], bool((times == 1).all())
        for token, node, branch, rows in steps(head, leaves, history):
            # One sort of (row, place) brings the places of a row together, so the table is read and written once a row.
            bits = rows.size.bit_length()
            kind = np.uint32 if ROW_BITS + bits <= 32 else np.uint64
            order = (rows.T.astype(kind, order="C").reshape(-1) << kind(bits)) | np.arange(rows.size, dtype=kind)
            order.sort()
            row, at = order >> kind(bits), (order & kind((1 << bits) - 1)).astype(np.int64)
            new = np.concatenate([[True], row[1:] != row[:-1]])
            first, more, number = np.flatnonzero(new), np.flatnonzero(~new), np.cumsum(new) - 1
            hit, local = row[first].astype(np.int64), np.empty(rows.size, dtype=np.int64)
            local[at] = number
            held = np.take(weights, hit, axis=0)
            p = logits(held, head.bias, node, local.reshape(-1, len(rows)).T)
            np.exp(p, out=p)
            p *= (1 / np.einsum("ij->i", p))[:, None]
            p.reshape(-1)[taken(branch)] -= 1
            if not once:
                p *= times[token][:, None]
            at //= len(rows)
            step, other = np.take(p, at[first], axis=0), np.take(p, at[more], axis=0)
            place = np.repeat(number[more] * len(pairs), len(pairs)).reshape(-1, len(pairs)) + pairs
            np.add.at(step.view(np.complex64).reshape(-1), place.reshape(-1), other.view(np.complex64).reshape(-1))
            square = squares[hit] + np.einsum("ij,ij->i", step, step)
            squares[hit] = square
            step *= (RATE / np.sqrt(square))[:, None]
            held -= step
            lines[hit] = held.view(LINE).reshape(-1)
            met.append(rows.reshape(-1))
            often.append(times[:0] if once else np.tile(times[token], len(rows)))
        seen += np.bincount(np.concatenate(met), weights=None if once else np.concatenate(often), minlength=ROWS)
    return weights, seen


Rows = tuple[np.ndarray, np.ndarray, np.ndarray]


def shards(weights: np.ndarray, seen: np.ndarray) -> Iterator[tuple[int, Rows]]:
    """The rows of one bucket that were seen, by range of the table: numbers within the range, rows in half precision, times seen.

    These parts are most of what training writes, so numbers and times are as short as they can be, and the upper bytes of
    the halves (sign, exponent and two more bits) are compressed.
    """
    size = ROWS // SHARDS
    for shard in range(SHARDS):
        own = slice(shard * size, (shard + 1) * size)
        hit = np.flatnonzero(seen[own])
        if len(hit):
            times = seen[own][hit].astype(np.min_scalar_type(int(seen[own].max())))
            lower, upper = weights[own][hit].astype("<f2").view(np.uint8).reshape(-1, 2).T
            yield shard, (hit.astype(np.min_scalar_type(size - 1)), (lower.tobytes(), compress(upper.tobytes(), 1)), times)


def sums(part: Rows) -> np.ndarray:
    """Rows times how often they were seen; a part from one bucket has the rows themselves."""
    if not isinstance(part[1], tuple):
        return part[1]
    lower, upper = part[1][0], decompress(part[1][1])
    halves = np.stack([np.frombuffer(own, dtype=np.uint8) for own in (lower, upper)], axis=1).view("<f2")
    return halves.reshape(-1, WIDTH).astype(np.float64) * part[2][:, None]


def add_rows(a: Rows, b: Rows) -> Rows:
    """The sum of two sparse tables (row numbers, rows, times seen)."""
    hit = np.union1d(a[0], b[0])
    # Halves times counts add up exactly in doubles, so the order of the tasks does not show in the weights.
    rows, seen = np.zeros((len(hit), WIDTH)), np.zeros(len(hit))
    for part in (a, b):
        at = np.searchsorted(hit, part[0])
        rows[at] += sums(part)
        seen[at] += part[2]
    return hit, rows, seen


def read_texts(reader: Reader, texts: Sequence[str | None]) -> Iterator[tuple[Tokens, np.ndarray, np.ndarray]]:
    """Whole texts piece by piece: their tokens, leaves and hashed histories."""
    for piece in pieces([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])]):
        found = reader.read(piece.column("text"))
        yield found, found.leaves, found.history()


def leaf_bytes(leaves: np.ndarray) -> bytes:
    """Leaf numbers in three bytes each: all lower two, then all upper ones, which shrink well."""
    return leaves.astype("<u2").tobytes() + (leaves >> 16).astype(np.uint8).tobytes()


def leaf_numbers(held: bytes) -> np.ndarray:
    size = len(held) // 3
    return np.frombuffer(held, dtype="<u2", count=size).astype(np.int32) | np.frombuffer(held, dtype=np.uint8, offset=2 * size).astype(np.int32) << 16


def encoded(docs: DataFrame, shared) -> DataFrame:
    """Keyed documents as leaf numbers and the hashes of words outside the head; equal rows of a piece are one, ``times`` over."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader.of(shared.value)
        for piece in pieces(batches):
            own = pa.table({name: piece.column(name) for name in ("k_id", "k_text", "text")}).group_by(["k_id", "k_text", "text"]).aggregate([([], "count_all")])
            own = own.combine_chunks().to_batches()[0]
            found = reader.read(own.column("text"))
            rare = found.leaves >= len(reader.words)
            ends = np.cumsum(found.lengths)
            leaves = [leaf_bytes(part) for part in np.split(found.leaves, ends[:-1])]
            hashes = [part.tobytes() for part in np.split(found.hashes[rare].astype(np.uint32), np.cumsum(rare)[ends - 1][:-1])]
            yield pa.RecordBatch.from_arrays(
                [own.column("k_id"), own.column("k_text"), pa.array(leaves, pa.binary()), pa.array(hashes, pa.binary()), own.column("count_all").cast(pa.int64())],
                names=["k_id", "k_text", "leaves", "hashes", "times"],
            )

    id_type = docs.schema["k_id"].dataType.simpleString()
    return docs.mapInArrow(encode, f"k_id {id_type}, k_text long, leaves binary, hashes binary, times long")


def chunks_of(reader: Reader, rows: Iterable) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks of the encoded documents of one bucket, sorted: leaves, histories and times of every token."""

    def chunk():
        leaves = np.concatenate([leaf_numbers(row.leaves) for row, _ in held])
        hashes, rare = reader.hashes[leaves], leaves >= len(reader.words)
        hashes[rare] = np.concatenate([np.frombuffer(row.hashes, dtype=np.uint32) for row, _ in held])
        lengths = np.array([len(row.leaves) // 3 for row, _ in held])
        times = np.repeat(np.array([n for _, n in held], dtype=np.float32), lengths)
        return leaves, features(reader.classes[leaves], hashes, places(lengths)), times

    held, size = [], 0
    for _, same in groupby(rows, key=lambda row: (row.k_id, row.k_text, bytes(row.leaves), bytes(row.hashes))):
        row = next(same)
        held.append((row, row.times + sum(other.times for other in same)))
        size += len(row.leaves) // 3
        if size > CHUNK_TOKENS:
            yield chunk()
            held, size = [], 0
    if held:
        yield chunk()


def trained(docs: DataFrame, head: Head) -> np.ndarray:
    """The weights after all rounds over all keyed training documents."""
    spark = docs.sparkSession
    weights = np.zeros((ROWS, WIDTH), dtype=np.float32)
    if not head.total:
        return weights
    shared = spark.sparkContext.broadcast(Reader(head).shared())
    buckets = math.ceil(head.total / BUCKET_TOKENS)
    tasks = min(buckets, max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    dealt = encoded(docs, shared).withColumn("bucket", F.pmod(F.xxhash64("k_id", "k_text"), F.lit(buckets)))
    dealt = dealt.repartitionById(tasks, (F.col("bucket") % tasks).cast("int"))
    # One plan for all rounds: later ones read the files of its shuffle again.
    rows = dealt.sortWithinPartitions("bucket", "k_text", "k_id", "leaves", "hashes").rdd
    for _ in range(ROUNDS):
        current = spark.sparkContext.broadcast(weights)

        def update(rows) -> Iterator[tuple[int, Rows]]:
            reader = Reader.of(shared.value)
            for _, own in groupby(rows, key=lambda row: row.bucket):
                yield from shards(*fit(current.value, reader.head, chunks_of(reader, own)))

        weights = weights.copy()
        # Every range of the table is summed by a task of its own, after the buckets of a task; the driver gets the table once.
        summed = rows.mapPartitions(update).reduceByKey(add_rows, min(SHARDS, tasks))
        for shard, hit, mean in summed.map(lambda part: (part[0], part[1][0], (sums(part[1]) / part[1][2][:, None]).astype(np.float32))).collect():
            weights[shard * (ROWS // SHARDS) + hit.astype(np.int64)] = mean
        current.unpersist()
    return weights


def scores(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: key, n_tokens, n_known, train_tokens, base_score and score, learned where ``train`` holds."""
    spark = docs.sparkSession
    learn = keyed(docs.filter(train), id_col, text_col)
    vocabulary = stored(count_words(learn), "vocabulary")
    head = vocabulary_head(vocabulary)
    weights = spark.sparkContext.broadcast(trained(learn, head))
    shared = spark.sparkContext.broadcast(Reader(head).shared())
    columns = ["k_id", "k_text", "n_tokens", "n_known", "base", "own", "rare", "times", "leaf"]

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader.of(shared.value)
        head = reader.head
        # The last entry is for words outside the head, numbered -1.
        base = np.append(np.log10((head.counts + 0.5) / (head.total + 0.5 * (head.distinct + 1))), 0.0)
        # With no training words none is known.
        seen = math.log10(max(1 - head.unseen(), 1e-9))
        for piece in pieces(batches):
            found = reader.read(piece.column("text"))
            value = seen + leaf_scores(weights.value, head, found.leaves, found.history())
            ids, first = found.ids[found.which], np.cumsum(found.lengths) - found.lengths
            known = ids >= 0
            totals = [np.add.reduceat(x, first) for x in (known.astype(np.int64), base[ids], np.where(known, value, 0.0))]
            # The words outside the head by text and word.
            outside, width = np.flatnonzero(~known), len(found.words)
            text = np.repeat(np.arange(len(first)), found.lengths)[outside]
            pair, place, times = np.unique(text * width + found.which[outside], return_inverse=True, return_counts=True)
            ends = pa.array(np.searchsorted(pair, np.arange(len(first) + 1) * width), pa.int32())
            rare = found.words.take(pa.array(pair % width)).cast(pa.binary())
            lists = [rare, pa.array(times, pa.int64()), pa.array(np.bincount(place, weights=value[outside], minlength=len(pair)), pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [piece.column("k_id"), piece.column("k_text"), pa.array(found.lengths, pa.int64()), *(pa.array(x) for x in totals)]
                + [pa.ListArray.from_arrays(ends, values) for values in lists],
                names=columns,
            )

    source = keyed(docs, id_col, text_col)
    id_type = source.schema["k_id"].dataType.simpleString()
    schema = f"k_id {id_type}, k_text long, n_tokens long, n_known long, base double, own double, rare array<binary>, times array<long>, leaf array<double>"
    partial = stored(source.mapInArrow(scored, schema).withColumn("n", F.monotonically_increasing_id()), "scores")
    return _with_rare_words(partial, vocabulary, head)


def _with_rare_words(partial: DataFrame, vocabulary: DataFrame, head: Head) -> DataFrame:
    """Adds what the words outside the head contribute, by joining their counts."""
    rare = partial.select("n", F.inline(F.arrays_zip(F.col("rare").alias("word"), F.col("times").alias("times"), F.col("leaf").alias("leaf"))))
    kind = (F.crc32(F.expr("substring(word, -2, 2)")) % ENDINGS).cast("int")
    tokens_of, words_of = (F.get(F.lit([float(x) for x in values]).cast("array<double>"), kind) for values in (head.rare_tokens, head.ending_words))
    c = F.coalesce("c", F.lit(0))
    # A word outside the head is in a leaf of the tree if it was seen, else it has the share of its ending.
    unseen = F.log10(F.lit(head.unseen()) * (words_of + 1) / F.lit(float(head.distinct + ENDINGS)))
    own = F.when(c > 0, F.col("leaf") + F.col("times") * F.log10(c / F.greatest(tokens_of, F.lit(1.0)))).otherwise(F.col("times") * unseen)
    base = F.log10((c + 0.5) / F.lit(head.total + 0.5 * (head.distinct + 1)))
    more = (
        rare.join(vocabulary, "word", "left")
        .groupBy("n")
        .agg(
            F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more_known"),
            F.sum(base * F.col("times")).alias("more_base"),
            F.sum(own).alias("more_own"),
        )
    )
    zero = F.lit(0)
    return partial.drop("rare", "times", "leaf").join(more, "n", "left").select(
        *KEY,
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(head.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
        (F.col("own") + F.coalesce("more_own", zero)).alias("score"),
    )
