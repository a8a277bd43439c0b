"""Quality rules as a bitmask ledger (operator 2), in DataFrame functions only.

Every rule is evaluated once per text. The ledger keeps the measurements and one bit per
failed rule, so a policy, which is a set of rules, is one ``&`` on the ledger, and the effect
of leaving a rule out is an aggregate over bits; no text is read again for either.

Null texts have no words. Empty tables give empty ledgers. Repeated rows give repeated rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.common import text_of

WORD = r"[^\x20\x09-\x0D]+"

#: Name and failing condition over the measurements; a rule's bit is its place here.
#: Append new rules at the end, so that stored ledgers keep their meaning.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    ("shouting", "5 * n_bangs > n_words"),
)
BITS = {name: 1 << place for place, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version of the keep decision: the rules that a kept document must not fail."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[name] for name in self.rules)


BASE = Policy("base", ("few_words", "repeated_words"))
V1 = Policy("v1", tuple(BITS))


def repeated_positions(words: str, n: int) -> str:
    """SQL for the sorted starts of n-word windows that occur twice or more in ``words``.

    The windows' hashes are sorted with their places; equal neighbours are repeats. One sort
    per text, so the cost stays near linear in its length however many windows repeat.
    """
    following = ", ".join(f"get({words}, i + {k})" for k in range(1, n))
    return (
        f"if(size({words}) < {n}, array(), sort_array(transform("
        f"slice({words}, 1, greatest(size({words}) - {n - 1}, 0)), "
        f"(w, i) -> struct(xxhash64(w, {following}) AS h, i AS i))))"
    )


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with the counts that the rules read."""
    body = docs.select(F.col(key).alias("key"), text_of(text).alias("body"))
    split = body.select(
        "key",
        F.regexp_extract_all("body", F.lit(WORD), F.lit(0)).alias("words"),
        F.expr(r"filter(split(body, '\n', -1), l -> l rlike '[^\\x20\\x09-\\x0D]')").alias("lines"),
        F.regexp_count("body", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("body", F.lit("!")).cast("long").alias("n_bangs"),
    )
    sorted_windows = split.select(
        "key", "n_symbols", "n_bangs",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        F.expr("cast(size(lines) - size(array_distinct(lines)) AS bigint)").alias("n_dup_lines"),
        F.expr(repeated_positions("words", 3)).alias("windows"),
    )
    repeats = sorted_windows.withColumn("repeats", F.expr(
        "sort_array(transform(filter(windows, (x, i) -> x.h = get(windows, i - 1).h "
        "OR x.h = get(windows, i + 1).h), x -> x.i))"
    ))
    return repeats.select(
        F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.expr(
            "aggregate(transform(repeats, (x, i) -> least(3, coalesce(get(repeats, i + 1) - x, 3))), "
            "0L, (a, x) -> a + x)"
        ).alias("n_repeat_words"),
        "n_lines", "n_bangs",
    )


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Measurements and ``failed``, the bits of the rules that the document fails."""
    bits = F.lit(0).cast("long")
    for name, condition in RULES:
        failed = F.expr(condition)
        bits = bits.bitwiseOR(F.when(failed, F.lit(BITS[name])).otherwise(F.lit(0)).cast("long"))
    return measure(docs, key, text).withColumn("failed", bits)


def fails(policy: Policy, bits: str = "failed") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under a policy."""
    return rows.withColumns({"base_failed": fails(BASE), "kept": ~fails(BASE) & ~fails(policy)})


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of a policy: documents failing it, and those that it alone removes.

    Documents are first counted by their bits, of which there are at most 2^rules.
    """
    counts = rows.groupBy(
        F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long")).alias("bits")
    ).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.lit(BITS[name]).cast("long").alias("bit"))
        for name in policy.rules
    ])).alias("r")
    return counts.select("bits", "n", rules).groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
    ).withColumn("policy", F.lit(policy.version))
