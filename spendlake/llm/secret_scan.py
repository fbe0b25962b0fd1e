"""Secret scans through a trigram inverted index.

From each rule's pattern a Boolean query over lower-case trigrams is derived: an
OR of branches, each the AND of the trigrams any match must hold. The index
lists, per trigram, the documents that hold it; intersecting the lists leaves
the candidates, and only those are searched with the pattern. A rule whose
pattern has no mandatory trigram (a plain character class) searches everything.

Main path: DataFrame functions only. Defined results: a null or empty text has
no secrets; rows that share an id are searched each by its own text, and rows
that repeat id and text get the same spans; overlapping spans of different
rules are all kept; further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.text import KEY, keyed, lower_ascii, same_key, stored


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``value`` is the group that must have ``least`` characters (0: the match)."""

    kind: str
    pattern: str
    value: int = 0
    least: int = 0


# The kinds and patterns that every scan must report, in their order.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
# Public token formats beyond the base.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
)
RULES = BASE_RULES + MORE_RULES

# A branch with more alternatives than this is cut into its parts instead of multiplied out.
MAX_BRANCHES = 64

# The literal runs one alternative of a pattern must hold: (runs already closed, run still open).
_Branch = tuple[tuple[str, ...], str]
_ANYTHING: list[_Branch] = [(("",), "")]


def _closed(branch: _Branch) -> tuple[str, ...]:
    return (*branch[0], branch[1])


def _join(left: list[_Branch], right: list[_Branch]) -> list[_Branch]:
    """Every left alternative followed by every right one; an open run goes on into the next."""
    joined = []
    for (done, tail), (more, end) in product(left, right):
        if more:
            joined.append(((*done, tail + more[0], *more[1:]), end))
        else:
            joined.append((done, tail + end))
    if len(joined) > MAX_BRANCHES:
        joined = [((*_closed(branch), ""), "") for branch in left]
    return joined


def _literals(parsed: Iterable) -> list[_Branch]:
    """The alternatives of a parsed pattern as mandatory literal runs."""
    found: list[_Branch] = [((), "")]
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            part: list[_Branch] = [((), chr(arg))]
        elif name == "IN" and len(arg) <= 8 and all(str(o) == "LITERAL" for o, _ in arg):
            part = [((), chr(a)) for _, a in arg]
        elif name == "SUBPATTERN":
            part = _literals(arg[-1])
        elif name == "BRANCH":
            part = [branch for choice in arg[1] for branch in _literals(choice)]
        elif name == "MAX_REPEAT":
            least, most, inner = arg
            once = _literals(inner)
            if (least, most) == (0, 1):
                part = [((), ""), *once]
            elif least == most == 1:
                part = once
            elif 1 <= least == most <= 8 and len(once) == 1 and not once[0][0]:
                part = [((), once[0][1] * least)]
            elif least:
                part = [((*_closed(branch), ""), "") for branch in once]
            else:
                part = _ANYTHING
        else:
            part = _ANYTHING
        found = _join(found, part)
    return found


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The OR of trigram sets a text must hold to match; empty if some match needs no trigram."""
    branches = set()
    for branch in _literals(re._parser.parse(pattern)):
        runs = [run.lower() for run in _closed(branch)]
        grams = frozenset(run[i : i + 3] for run in runs for i in range(len(run) - 2) if run[i : i + 3].isascii())
        if not grams:
            return []
        branches.add(grams)
    return sorted((b for b in branches if not any(other < b for other in branches)), key=sorted)


def postings(docs: DataFrame, grams: Sequence[str]) -> DataFrame:
    """The inverted lists (gram, key) of the given trigrams over keyed documents."""
    low = docs.select(*KEY, lower_ascii(F.col("text")).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    return low.select(*KEY, F.explode(held).alias("gram"))


def candidates(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows (key, rule): documents whose trigrams satisfy the rule's query. Rules without one are not asked."""
    branches = [(n, b, gram, len(grams)) for n, rule in enumerate(rules) for b, grams in enumerate(trigram_query(rule.pattern)) for gram in grams]
    if not branches:
        return docs.select(*KEY, F.lit(0).alias("rule")).limit(0)
    spark = docs.sparkSession
    asked = spark.createDataFrame(branches, "rule int, branch int, gram string, n_grams int")
    lists = postings(docs, sorted({gram for _, _, gram, _ in branches}))
    # One row per list entry and branch; as many rows as the query has trigrams means all lists were hit.
    return (
        lists.join(F.broadcast(asked), "gram")
        .groupBy(*KEY, "rule", "branch")
        .agg(F.count_distinct("gram").alias("n_held"), F.first("n_grams").alias("n_grams"))
        .filter("n_held = n_grams")
        .select(*KEY, "rule")
        .distinct()
    )


def _found(text: Column, number: int, rule: Rule) -> Column:
    """The matches of one rule in order, as structs: rule, gap before it, its size, its value's size.

    The text is its gaps and matches in turn, so a match ends at the sum of all up to it.
    """
    pattern = F.lit(rule.pattern)
    sizes = lambda group: F.transform(F.regexp_extract_all(text, pattern, F.lit(group)), lambda m: F.length(m))
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda gap: F.length(gap))
    both = F.arrays_zip(gaps.alias("gap"), sizes(0).alias("size"), sizes(rule.value).alias("value"))
    rows = F.transform(both, lambda m: F.struct(F.lit(number).alias("rule"), m["gap"].alias("gap"), m["size"].alias("size"), m["value"].alias("value")))
    return F.when(text.rlike(rule.pattern), rows)


def _searched(docs: DataFrame, rules: Sequence[tuple[int, Rule]], asked: Column | None) -> DataFrame:
    """Rows (key, n, m): all matches of the rules, of those in ``asked`` if given, numbered within a document."""
    nothing = F.expr("CAST(array() AS array<struct<rule:int,gap:int,size:int,value:int>>)")
    text = F.col("text")
    lists = [
        F.coalesce(_found(text, n, rule) if asked is None else F.when(F.array_contains(asked, n), _found(text, n, rule)), nothing)
        for n, rule in rules
    ]
    return docs.select(*KEY, F.posexplode(F.concat(nothing, *lists)).alias("n", "m"))


def secret_spans(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Rows (key, rule, start, end), rule being the position in ``rules``. ``docs`` is keyed."""
    numbered = list(enumerate(rules))
    indexed = [(n, rule) for n, rule in numbered if trigram_query(rule.pattern)]
    scanned = [(n, rule) for n, rule in numbered if not trigram_query(rule.pattern)]
    parts = []
    if indexed:
        likely = candidates(docs, rules).groupBy(*KEY).agg(F.collect_set("rule").alias("asked"))
        likely = stored(likely, "secret-candidates")
        some = docs.join(likely, same_key(docs, likely)).select(docs["k_id"], docs["k_text"], docs["text"], "asked")
        parts.append(_searched(some, indexed, F.col("asked")))
    if scanned:
        parts.append(_searched(docs, scanned, None))
    least = F.array(*[F.lit(rule.least) for rule in rules])
    upto = F.sum(F.col("m.gap") + F.col("m.size")).over(
        Window.partitionBy(*KEY, "m.rule").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        reduce(DataFrame.unionByName, parts)
        .filter("m.size IS NOT NULL")
        # Rows that repeat id and text found the same matches.
        .distinct()
        .select(*KEY, "m", upto.cast("long").alias("end"))
        .filter(F.col("m.value") >= F.get(least, F.col("m.rule")))
        .select(*KEY, F.col("m.rule").alias("rule"), (F.col("end") - F.col("m.size")).alias("start"), "end")
    )


def span_text(rows: Column, kinds: Sequence[str]) -> Column:
    """kind:start:end of sorted (start, rule, end) structs, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in kinds])
    one = lambda s: F.concat_ws(":", F.get(names, s["rule"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(rows, one), ",")


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its key and ``found``: structs (start, rule, end) by start, then rule."""
    source = keyed(docs, id_col, text_col)
    found = secret_spans(source, rules).groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("start", "rule", "end"))).alias("found"))
    ids = source.select(*KEY)
    return ids.join(found, same_key(ids, found), "left").select(
        ids["k_id"], ids["k_text"], F.coalesce("found", F.expr("CAST(array() AS array<struct<start:bigint,rule:int,end:bigint>>)")).alias("found")
    )
