"""Quality rules as a ledger of bits.

Every rule is evaluated once per document. Its failure is one bit of a mask and
its measurement one column; the ledger is what a run stores. A policy is a
version with the mask of the rules it obeys, so another policy, or the effect
of leaving a rule out, is answered from the stored bits without the texts.

Main path: DataFrame functions only. Defined results: a null or empty text has
no words and fails ``few_words``; rules about shares do not fail without words;
rows are judged one by one, so repeated rows, ties and null ids need no rule;
further columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.text import SPACES, gram_hashes, let, words

GRAM = 5

# Rule by bit: the name and the SQL condition, over the measurements, of failing it.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "n_symbols > n_words"),
    ("duplicate_lines", "2 * n_dup_lines > n_lines AND n_lines > 3"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 40 * n_words"),
)
BASE = ("few_words", "repeated_words")
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "duplicate_lines"),
    "v3": tuple(name for name, _ in RULES),
}


def _repeated(tokens: Column, size: int) -> Column:
    """Words inside runs of ``size`` words that occur twice or more, the first included.

    Runs are compared by 64-bit hashes, and sorted with their places only if two are equal.
    """

    def marked(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(
            placed,
            lambda s: F.filter(
                s,
                lambda x, i: F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(s, F.when(i > 0, i - 1))["h"] == x["h"], F.lit(False)),
            ),
        )
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(places: Column) -> Column:
        new = F.transform(
            places, lambda p, i: F.least(F.lit(size), F.coalesce(F.get(places, i + 1) - p, F.lit(size))).cast("long")
        )
        return F.aggregate(new, F.lit(0).cast("long"), lambda total, n: total + n)

    return let(
        gram_hashes(tokens, size),
        lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), let(marked(h), covered)).otherwise(F.lit(0).cast("long")),
    )


def measured(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The measurements of every document next to the columns ``keep``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(" \t\n\x0b\f\r")) != "")
    counted = docs.select(*keep, text.alias("q_text"), words(text).alias("q_words"), lines.alias("q_lines"))
    length = F.length("q_text")
    return counted.select(
        *keep,
        F.size("q_words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("q_text", f"[{SPACES}]+", "")).cast("long").alias("word_chars"),
        (length - F.length(F.regexp_replace("q_text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        F.size("q_lines").cast("long").alias("n_lines"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("q_words"), GRAM).alias("n_repeat_words"),
    )


def mask_of(names: tuple[str, ...]) -> int:
    bits = {name: bit for bit, (name, _) in enumerate(RULES)}
    return sum(1 << bits[name] for name in names)


def ledger(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Measurements and ``failed_bits``: bit b is set if rule b fails."""
    bits = [F.when(F.expr(condition), F.lit(1 << bit)).otherwise(0) for bit, (_, condition) in enumerate(RULES)]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured(docs, text_col, keep).withColumn("failed_bits", total.cast("long"))


def kept_by(policy: str, policies: Mapping[str, tuple[str, ...]] = POLICIES) -> Column:
    """True where no rule of the policy fails."""
    return F.col("failed_bits").bitwiseAND(F.lit(mask_of(policies[policy]))) == 0


def ablations(rows: DataFrame, policies: Mapping[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """Per policy and rule: documents, kept, and kept if that rule were left out.

    Only the counts of distinct masks, at most 2 to the number of rules, are expanded.
    """
    masks = rows.groupBy("failed_bits").agg(F.count("*").alias("n"))
    cases = F.array(
        *[
            F.struct(
                F.lit(version).alias("policy"),
                F.lit(rule).alias("rule"),
                F.lit(mask_of(names)).cast("long").alias("mask"),
                F.lit(mask_of(names) & ~mask_of((rule,))).cast("long").alias("without"),
            )
            for version, names in policies.items()
            for rule in names
        ]
    )
    passed = lambda mask: F.sum(F.when(F.col("failed_bits").bitwiseAND(F.col(mask)) == 0, F.col("n")).otherwise(0))
    return (
        masks.select("failed_bits", "n", F.inline(cases))
        .groupBy("policy", "rule")
        .agg(F.sum("n").alias("n_docs"), passed("mask").alias("n_kept"), passed("without").alias("n_kept_without"))
    )
