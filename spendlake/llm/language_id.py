"""Language identification by compression.

Per language one zstandard dictionary of raw text is built from a bounded sample
of labelled documents. A text is cut into pieces, each piece is compressed with
every dictionary, and the language with the fewest bytes over the whole text is
chosen. Short texts and near ties are encoded again with more effort, which then
decides. The margin to the runner-up, as a share of the runner-up's bytes, is the
score; a text whose margin is narrow is rejected.

The sample is bounded by ``ROWS_PER_LANGUAGE`` documents and by
``DICTIONARY_BYTES``, which they share: a longer document gives pieces of whole
words from all over its text, evenly spaced. Copies of a text count once. The
documents are those with the smallest hashes of their text, so the sample does
not depend on the order of rows; they are found in two steps, by language and
part of the hashes and then by language. Predictions read whole texts.

Defined results: a letter is what ``str.isalpha`` says; a null text or one without a letter is ``und`` with score 0 and
rejected; with no labelled row everything is ``und``; with one language every
text with a letter is that language with score 1; of a few words with equal byte
counts all beginnings and ends are encoded too; if that is equal as well the
language of more labelled rows is taken (then the first by name), with score 0. Rows are judged one by one.
"""

from __future__ import annotations

import re

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.text import keyed, set_aside, stored

ROWS_PER_LANGUAGE = 400
DICTIONARY_BYTES = 1 << 17
# Parts of the hashes that are thinned out one by one, so that a language of most rows is not one task's.
HASH_PARTS = 64
# Bytes that one document gives at most, and of one piece of a longer one.
EXCERPT_BYTES = 4_096
SPAN_BYTES = 64
PIECE_BYTES = 2_048
# Effort of the first encoding, and of the one that decides short texts and near ties.
LEVEL, CLOSE_LEVEL = 3, 12
CLOSE_MARGIN = 0.04
SHORT_BYTES = 400
# A margin below this is no evidence for either language.
MIN_MARGIN = 0.002
UNKNOWN = "und"

# Word characters but digits and the underscore; of these, what is no letter is taken out.
LETTERS = re.compile(r"[^\W\d_]+")


def letters_only(text: str | None) -> bytes:
    """The words of a text, letters only, in lower case, one space apart."""
    if not text:
        return b""
    words = LETTERS.findall(text.lower())
    if not text.isascii():
        words = [part for word in words for part in ([word] if word.isalpha() else "".join(c if c.isalpha() else " " for c in word).split())]
    return " ".join(words).encode()


def spaced(content: bytes, size: int) -> bytes:
    """At most ``size`` bytes of a text, in pieces of whole words that are evenly spaced over all of it."""
    if len(content) <= size:
        return content
    pieces, count = [], max(1, size // SPAN_BYTES)
    for n in range(count):
        start = n * (len(content) - SPAN_BYTES) // count
        start = content.find(b" ", start) + 1 if start else 0
        piece = content[start : start + SPAN_BYTES]
        pieces.append(piece[: piece.rfind(b" ") + 1] or piece)
    return b"".join(pieces)[:size]


def spread(parts: list[bytes], budget: int) -> bytes:
    """All parts in a row, the longer ones thinned to one length at which they fit."""
    taken = {}
    for k, n in enumerate(sorted(range(len(parts)), key=lambda n: len(parts[n]))):
        taken[n] = min(len(parts[n]), budget // (len(parts) - k))
        budget -= taken[n]
    return b"".join(spaced(part, taken[n]) for n, part in enumerate(parts))


def dictionaries(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """The raw dictionary of every language among the labelled rows given.

    What reaches the driver is excerpts, taken from whole texts in the tasks: at
    most ``2 * DICTIONARY_BYTES`` a language.
    """
    labelled = keyed(docs.filter(F.col(lang_col).isNotNull()), text_col, text_col, F.col(lang_col).alias("k_lang"))
    labelled = labelled.drop("k_id").filter(F.col("text") != "")
    # The limit per group is applied in each task before anything is moved.
    part = F.pmod("k_text", F.lit(HASH_PARTS))
    first = F.row_number().over(Window.partitionBy("k_lang", "part").orderBy("k_text"))
    some = labelled.select("k_lang", "k_text").distinct().withColumn("part", part).withColumn("first", first).filter(F.col("first") <= ROWS_PER_LANGUAGE)
    best = F.row_number().over(Window.partitionBy("k_lang").orderBy("k_text"))
    chosen = some.select("k_lang", "k_text").withColumn("first", best).filter(F.col("first") <= ROWS_PER_LANGUAGE)
    share = F.least(F.lit(EXCERPT_BYTES), F.floor(F.lit(2 * DICTIONARY_BYTES) / F.count("*").over(Window.partitionBy("k_lang"))))
    ids = stored(chosen.select("k_lang", "k_text", share.alias("share")), "sample-ids")

    @F.pandas_udf("binary")
    def excerpt(texts: pd.Series, shares: pd.Series) -> pd.Series:
        return pd.Series([spaced(letters_only(text), share) + b" " for text, share in zip(texts, shares)])

    sample = labelled.join(F.broadcast(ids), ["k_lang", "k_text"]).select("k_lang", "k_text", excerpt("text", "share").alias("part"))
    rows = sorted((r.k_lang, r.k_text, bytes(r.part)) for r in sample.dropDuplicates(["k_lang", "k_text"]).collect())
    parts: dict[str, list[bytes]] = {}
    for lang, _, content in rows:
        parts.setdefault(lang, []).append(content)
    labels = {row.k_lang: row.n for row in labelled.groupBy("k_lang").agg(F.count("*").alias("n")).filter(F.col("k_lang").isin(list(parts))).collect()}
    # The most frequent language first.
    raw = {lang: spread(parts[lang], DICTIONARY_BYTES) for lang in sorted(parts, key=lambda lang: (-labels[lang], lang))}
    return {lang: content for lang, content in raw.items() if content.strip()}


Compressors = dict[str, zstandard.ZstdCompressor]


def compressors(raw: dict[str, bytes], level: int) -> Compressors:
    made = {}
    for lang, content in raw.items():
        content = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=level)
        made[lang] = zstandard.ZstdCompressor(
            level=level, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False
        )
    return made


def smallest(content: bytes, by_language: Compressors) -> tuple[str, float]:
    """The language of the fewest bytes and its margin; of equal ones the first, as the most frequent ones come first."""
    pieces = [content[i : i + PIECE_BYTES] for i in range(0, len(content), PIECE_BYTES)]
    sizes = sorted((sum(len(c.compress(piece)) for piece in pieces), n, lang) for n, (lang, c) in enumerate(by_language.items()))
    if len(sizes) > 1 and sizes[0][0] == sizes[1][0] and len(content) <= SHORT_BYTES:
        # Whole bytes are too coarse for a few words: all beginnings and ends of them are encoded.
        parts = [part for i in range(1, len(content)) for part in (content[:i], content[i:])]
        tied = [(n, lang) for size, n, lang in sizes if size == sizes[0][0]]
        sizes = sorted((sum(len(by_language[lang].compress(part)) for part in parts), n, lang) for n, lang in tied)
    if len(sizes) == 1:
        return sizes[0][2], 1.0
    return sizes[0][2], (sizes[1][0] - sizes[0][0]) / max(sizes[1][0], 1)


def classify(text: str | None, fast: Compressors, close: Compressors) -> tuple[str, float]:
    """The language of the smallest encoding of the whole text, and its margin."""
    content = letters_only(text)
    if not content or not fast:
        return UNKNOWN, 0.0
    if len(content) > SHORT_BYTES:
        lang, margin = smallest(content, fast)
        if margin >= CLOSE_MARGIN:
            return lang, margin
    return smallest(content, close)


def predictor(docs: DataFrame, raw: dict[str, bytes]):
    """A column function: text to struct<lang_pred, score>."""
    shared = docs.sparkSession.sparkContext.broadcast(raw)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        if "made" not in cache:
            cache["made"] = [compressors(shared.value, level) for level in (LEVEL, CLOSE_LEVEL)]
        return pd.DataFrame([classify(text, *cache["made"]) for text in texts], columns=["lang_pred", "score"])

    cache: dict = {}
    return predict


def identify(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """All columns and ``language``: struct<lang_pred, score>, learned from the rows where ``train`` holds.

    A column of the documents named ``language`` is kept as ``language_input``.
    """
    raw = dictionaries(docs.filter(train), text_col, lang_col)
    return set_aside(docs, "language").withColumn("language", predictor(docs, raw)(F.col(text_col)))


def accepted(language: Column, min_margin: float = MIN_MARGIN) -> Column:
    return (language["lang_pred"] != UNKNOWN) & (language["score"] >= min_margin)


def keep_identified(docs: DataFrame, train: Column) -> DataFrame:
    """The documents whose language is not rejected, with their own columns."""
    packed = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    language = predictor(docs, dictionaries(docs.filter(train)))(F.col("text"))
    return packed.withColumn("language", language).filter(accepted(F.col("language"))).select("row.*")
