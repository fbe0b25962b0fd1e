"""Personal data: patterns, and terms that give a protected entity away.

Protected entities are the strings the patterns find (mail and network
addresses, card and phone numbers). The corpus tells how strongly a nearby term
reveals one: with n(e) documents holding the entity out of N, n(t) holding the
term and n(t, e) holding the term next to the entity, the pointwise mutual
information log(n(t, e) N / (n(t) n(e))) as a share of the entity's whole
information log(N / n(e)) is the disclosure of the term. Terms that reach the
threshold, seen next to the entity in several different contexts, are removed
wherever they occur; entities are replaced by their kind.

Defined results: a null or empty text has no spans; rows are searched one by
one, and rows that repeat a text count as documents but not as contexts; of
equal contexts one counts; spans of different kinds may overlap and are all
reported, and in sanitised text overlapping spans are replaced as one; further
columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.text import KEY, keyed, stored

KINDS = ("email", "ip", "card", "phone", "term")
WINDOW = 5
MIN_CONTEXTS = 3
MIN_DISCLOSURE = 0.9
# Up to this many terms a set of them is sent to every task; beyond it terms are joined.
BROADCAST_TERMS = 200_000

LOCAL = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits fails or matches from its start, so no later start in it is tried.
ADDRESS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TERM = re.compile(r"[^\W\d_]+")

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(int(d) for d in digits[-1::-2]) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def entities(text: str) -> list[Span]:
    """The spans of the four patterns, by kind and start, in code points."""
    if not text:
        return []
    found = [("email", *span) for span in emails(text)]
    for m in ADDRESS.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in DIGITS.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append(("phone", *m.span()))
    return found


def terms(text: str) -> set[str]:
    return {word.lower() for word in TERM.findall(text)} if text else set()


def contexts(text: str, window: int = WINDOW) -> set[tuple[str, str, int | None]]:
    """(entity, term, context) of the nearest whole words on either side of each entity.

    Besides, once each: every pair of them with no context (None), for the document
    itself, every entity with the term '', and every such word with the entity ''.
    """
    rows: set[tuple[str, str, int | None]] = set()
    found = entities(text)
    # All words are placed once, so many entities far from any word cost no more than the text.
    spans = [m.span() for m in TERM.finditer(text)] if found else []
    starts, ends = [s for s, _ in spans], [e for _, e in spans]
    for _, start, end in found:
        entity = text[start:end].lower()
        left, right = bisect_right(ends, start), bisect_left(starts, end)
        whole = (*spans[max(0, left - window) : left], *spans[right : right + window])
        near = [text[s:e].lower() for s, e in whole]
        context = int.from_bytes(hashlib.blake2b(" ".join(near).encode(), digest_size=7).digest())
        rows.add((entity, "", None))
        for word in near:
            rows |= {(entity, word, context), (entity, word, None), ("", word, None)}
    return rows


def co_occurrences(docs: DataFrame) -> DataFrame:
    """(entity, term, contexts, n_docs) over keyed documents."""

    def pairs(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([row for text in frame["text"] for row in contexts(text)], columns=["entity", "term", "context"]).astype({"context": "Int64"})

    # Every pattern needs a digit or the sign of a mail address.
    likely = docs.filter(F.col("text").rlike("[0-9@]")).select("text")
    once = likely.mapInPandas(pairs, "entity string, term string, context long").groupBy("entity", "term", "context")
    # The row without a context counts documents; the others only tell how many contexts there are.
    n_docs = F.sum(F.when(F.col("context").isNull(), F.col("n"))).alias("n_docs")
    return once.agg(F.count("*").alias("n")).groupBy("entity", "term").agg(F.count("context").alias("contexts"), n_docs)


def _terms_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, term): the wanted terms that a document holds, once each."""
    n = wanted.count()
    few = {row.term for row in wanted.collect()} if n <= BROADCAST_TERMS else None
    chosen = docs.sparkSession.sparkContext.broadcast(few)

    @F.pandas_udf("array<string>")
    def held(texts: pd.Series) -> pd.Series:
        some = chosen.value
        return texts.map(lambda text: sorted(terms(text) if some is None else terms(text) & some))

    rows = docs.select(*KEY, F.explode(held(F.col("text"))).alias("term"))
    return rows if few is not None else rows.join(wanted, "term", "left_semi")


def disclosing_terms(
    docs: DataFrame, min_contexts: int = MIN_CONTEXTS, min_disclosure: float = MIN_DISCLOSURE
) -> DataFrame:
    """(term, entity, disclosure) of the terms that give an entity away, over keyed documents."""
    pairs = stored(co_occurrences(docs), "co-occurrences")
    total = math.log(max(docs.count(), 1))

    def disclosure(n_term: str) -> Column:
        surprise = F.lit(total) - F.log("n_entity")
        given = F.log(F.least(F.col("n_docs") / F.col(n_term), F.lit(1.0)))
        return F.when(surprise > 0, (given + surprise) / surprise).otherwise(0.0)

    held = pairs.filter("term = ''").select("entity", F.col("n_docs").alias("n_entity"))
    # A word is in no fewer documents than it is next to some entity, so this bound keeps all that can reach the threshold.
    near_any = pairs.filter("entity = ''").select("term", F.col("n_docs").alias("n_near"))
    candidates = pairs.filter((F.col("term") != "") & (F.col("entity") != "") & (F.col("contexts") >= min_contexts))
    candidates = candidates.join(held, "entity").join(near_any, "term").filter(disclosure("n_near") >= min_disclosure)
    candidates = stored(candidates, "candidates")
    if candidates.isEmpty():
        return candidates.select("term", "entity", F.lit(1.0).alias("disclosure"))
    n_term = _terms_of(docs, candidates.select("term").distinct()).groupBy("term").agg(F.count("*").alias("n_term"))
    scored = candidates.join(n_term, "term").withColumn("disclosure", disclosure("n_term"))
    return scored.filter(F.col("disclosure") >= min_disclosure).select("term", "entity", "disclosure")


def term_spans(text: str, chosen: Iterable[str]) -> list[Span]:
    chosen = set(chosen)
    return [("term", *m.span()) for m in TERM.finditer(text) if m[0].lower() in chosen] if chosen and text else []


def span_text(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def sanitise(text: str, spans: Iterable[Span]) -> str:
    """The text with entities generalised to their kind and disclosing terms removed."""
    parts, done = [], 0
    for start, end, kind in sorted((start, end, kind) for kind, start, end in spans):
        if start >= done:
            parts += [text[done:start], "" if kind == "term" else f"<{kind}>"]
        done = max(done, end)
    return "".join(parts) + text[done:]


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its key, the base spans and all spans as text, counts per kind, and the sanitised text."""
    source = keyed(docs, id_col, text_col)
    revealing = stored(disclosing_terms(source).select("term").distinct(), "revealing")
    n = revealing.count()
    few = {row.term for row in revealing.collect()} if n <= BROADCAST_TERMS else None
    chosen = docs.sparkSession.sparkContext.broadcast(few)
    if few is None:
        own = _terms_of(source, revealing).groupBy(*KEY).agg(F.collect_set("term").alias("own"))
        own = own.withColumnsRenamed({"k_id": "own_id", "k_text": "own_text"})
        same = F.col("k_id").eqNullSafe(F.col("own_id")) & (F.col("k_text") == F.col("own_text"))
        source = source.join(own, same, "left").select(*KEY, "text", "own")
    else:
        source = source.withColumn("own", F.lit(None).cast("array<string>"))
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)

    @F.pandas_udf(f"{counts}, base string, spans string, sanitised string")
    def search(texts: pd.Series, owned: pd.Series) -> pd.DataFrame:
        rows = []
        for text, own in zip(texts, owned):
            base = entities(text)
            spans = base + term_spans(text, (own if own is not None else ()) if chosen.value is None else chosen.value)
            kinds = [kind for kind, _, _ in spans]
            rows.append((*[kinds.count(kind) for kind in KINDS], span_text(base), span_text(spans), sanitise(text, spans)))
        return pd.DataFrame(rows, columns=[*(f"n_{kind}" for kind in KINDS), "base", "spans", "sanitised"])

    return source.select(*KEY, search("text", "own").alias("found")).select(*KEY, "found.*")
