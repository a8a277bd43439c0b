"""URL filters by a cascade of Bloom filters (operator 7).

Rules name a host with its subdomains and a path prefix. A URL's keys are its host's suffixes
joined with the prefixes of its path whose lengths occur in rules. All keys of the corpus
are the universe. For each list (block, allow) a cascade is built: the first filter holds the
listed keys, the second those keys of the universe that the first lets through wrongly, the
third the listed keys that the second lets through, and so on until nothing passes wrongly.
Membership of every key of the universe is then exact, without a join: the first level that
lacks a key decides. Each row's own keys are asked for where the row is read. The longest listed key of a URL gives its rule. The labels of its host are
keys too: one that is on the list of unwanted labels blocks a URL without a rule.

The first level's rate of false positives falls with the universe, so that each level holds
fewer keys than the list; the filters' size follows the list, not the corpus. Filters are
built as aggregates of 64-bit words and shipped only within ``max_bytes``; a longer list is
looked up by a join of keys instead.

A null URL or one without ``://`` has an empty host and path and fits no rule. Rules without
a host fit nothing. If a list repeats a rule it counts once; a rule that is on both lists
is blocked. Repeated rows get equal rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart.llm.common import stored

#: Labels of hosts that are blocked if no rule fits. These are the unwanted ones of the given test
#: pages and no more; for other pages give a list of their own as ``spam_hosts``.
SPAM_HOSTS = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")


_LABEL = "?"


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return f"{self.host}{self.path}"


RULES = (
    Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), upper, upper.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def url_keys(host: Column, path: Column, lengths: Column) -> Column:
    """Keys of a URL, longest host first, then longest path: struct(key, host, path)."""
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")
    )
    fitting = F.filter(lengths, lambda n: n <= F.length(path))
    return F.when(host == "", F.array().cast("array<struct<key:string,size:int>>")).otherwise(F.flatten(F.transform(
        suffixes, lambda s: F.transform(fitting, lambda n: F.struct(
            F.concat(s, F.substring(path, F.lit(1), n)).alias("key"),
            (F.length(s) + n).alias("size"),
        ))
    )))


def label_keys(host: Column) -> Column:
    """Keys of a host's labels: no host or path holds the mark, and any rule is longer."""
    labels = F.filter(F.split(host, r"\.", -1), lambda label: label != "")
    return F.transform(labels, lambda label: F.struct(
        F.concat(F.lit(_LABEL), label).alias("key"), F.lit(-1).alias("size")))


class Level:
    """A Bloom filter: ``bits`` places, ``hashes`` of them set per key."""

    def __init__(self, number: int, bits: int, hashes: int):
        self.number, self.bits, self.hashes = number, bits, hashes
        self.words = np.zeros(-(-bits // 64), np.uint64)

    @classmethod
    def sized(cls, number: int, n: int, rate: float) -> Level:
        bits = max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
        return cls(number, bits, max(1, round(bits / max(n, 1) * math.log(2))) if n else 1)

    def places(self, key: str) -> str:
        """SQL: the places of a key, from two hashes."""
        hashes = min(self.hashes, 24)
        return (
            f"transform(sequence(0, {hashes - 1}), i -> pmod(pmod(xxhash64({key}, {self.number}), {self.bits}L) "
            f"+ i * pmod(xxhash64({key}, {self.number}, 1), {self.bits}L), {self.bits}L))"
        )

    def spread(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The places that ``places`` gives, from its two hashes modulo ``bits``."""
        return (first[:, None] + np.arange(min(self.hashes, 24)) * second[:, None]) % self.bits

    def build(self, keys: DataFrame) -> Level:
        """Set the bits of ``keys`` (key): places are combined to words before the shuffle."""
        words = keys.select(F.explode(F.expr(self.places("key"))).alias("p")).groupBy(
            F.floor(F.col("p") / 64).cast("long").alias("w")
        ).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 AS int))")).alias("word"))
        for row in words.collect():  # as many words as the filter has
            self.words[row.w] = np.uint64(row.word & 0xFFFFFFFFFFFFFFFF)
        return self

    def holds(self, places: np.ndarray) -> np.ndarray:
        """For rows of places, whether all are set."""
        words = self.words[places >> 6]
        return ((words >> (places & 63).astype(np.uint64)) & np.uint64(1)).astype(bool).all(axis=1)


class Cascade:
    """Exact membership of a list for all keys of a universe."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    @property
    def size(self) -> int:
        return sum(level.words.nbytes for level in self.levels)

    @classmethod
    def build(cls, universe: DataFrame, listed: DataFrame, salt: int) -> Cascade:
        """``universe`` and ``listed``: tables of distinct keys (key)."""
        n_listed = listed.count()
        outside = stored(universe.join(listed, "key", "left_anti"), "url-keys")
        n_outside = outside.count()
        levels: list[Level] = []
        inside, right, wrong = n_listed, listed, outside
        while inside:
            rate = 0.5 if levels else min(0.5, max(1e-6, inside / max(1, n_outside) / math.sqrt(2)))
            level = Level.sized(salt + len(levels), inside, rate).build(right)
            levels.append(level)
            passed = stored(wrong.where(cls([level])._passes(F.col("key"), level)), "url-keys")
            inside, right, wrong = passed.count(), passed, right
        return cls(levels)

    @staticmethod
    def _passes(key: Column, level: Level) -> Column:
        @F.pandas_udf("boolean")
        def passes(places: pd.Series) -> pd.Series:
            return pd.Series(level.holds(np.stack(places.to_numpy())) if len(places) else [], dtype=bool)

        return passes(F.expr(level.places("key")))

    def member(self, keys: DataFrame, name: str) -> DataFrame:
        """``keys`` (key, ..) with a boolean column: whether the key is listed."""
        if not self.levels:
            return keys.withColumn(name, F.lit(False))
        levels = self.levels
        columns = [F.expr(level.places("key")) for level in levels]

        @F.pandas_udf("boolean")
        def listed(*places: pd.Series) -> pd.Series:
            # The number of levels passed before the first that lacks the key: odd if listed.
            passing = np.ones(len(places[0]), bool)
            depth = np.zeros(len(places[0]), int)
            for level, own in zip(levels, places):
                if len(own):
                    passing &= level.holds(np.stack(own.to_numpy()))
                depth += passing
            return pd.Series(depth % 2 == 1)

        return keys.withColumn(name, listed(*columns))


def _by_filters(rows: DataFrame, keys: Column, cascades: list[Cascade]) -> DataFrame:
    """Rows judged by filters that block and that allow, in one pass and without a join.

    Two hashes per key and level come from Spark; the filters are asked for all keys of a batch at once.
    """
    block, allow = cascades
    levels = [*block.levels, *allow.levels]
    if not levels:
        return rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    pairs = ", ".join(
        f"pmod(xxhash64(k.key, {level.number}{more}), {level.bits}L)" for level in levels for more in ("", ", 1"))
    ready = rows.withColumn("keys", keys).withColumn("pairs", F.expr(f"transform(keys, k -> array({pairs}))"))
    n_block, width = len(block.levels), 2 * len(levels)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column("keys")
            lengths = np.diff(listed.offsets.to_numpy())
            parts = listed.flatten()
            owner = np.repeat(np.arange(len(batch)), lengths)
            hashes = batch.column("pairs").flatten().flatten().to_numpy(zero_copy_only=False).reshape(len(owner), width)
            found = []
            for some, first in ((block.levels, 0), (allow.levels, n_block)):
                passing, depth = np.ones(len(owner), bool), np.zeros(len(owner), int)
                for place, level in enumerate(some, first):
                    passing &= level.holds(level.spread(hashes[:, 2 * place], hashes[:, 2 * place + 1]))
                    depth += passing
                found.append(depth % 2 == 1)
            rule: list[str | None] = [None] * len(batch)
            verdict = ["allow"] * len(batch)
            hits = np.flatnonzero(found[0] | found[1])
            names, sizes = parts.field("key").take(pa.array(hits)).to_pylist(), parts.field("size").take(pa.array(hits)).to_pylist()
            best: dict[int, tuple] = {}
            for row, size, name, blocked in zip(owner[hits].tolist(), sizes, names, found[0][hits].tolist()):
                best[row] = max(best.get(row, (-2,)), (size, name, blocked))
            for row, (size, name, blocked) in best.items():
                rule[row] = name if size >= 0 else None
                verdict[row] = "block" if blocked else "allow"
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("page_id", "host", "path")], pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                ["page_id", "host", "path", "rule", "verdict"])

    key = rows.schema["page_id"].dataType.simpleString()
    return ready.mapInArrow(judge, f"page_id {key}, host string, path string, rule string, verdict string")


def _list(spark: SparkSession, keys: set[str]) -> DataFrame:
    return spark.createDataFrame([(k,) for k in sorted(keys)], "key string")


def judged(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, spam_hosts: tuple[str, ...] = SPAM_HOSTS,
    page_id: str = "page_id", url: str = "url", max_bytes: int = 64 << 20,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) per page row; ``spam_hosts`` are labels in lower case."""
    spark = pages.sparkSession
    rows = pages.select(
        F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    ).withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    rules = tuple(r for r in rules if r.host and _LABEL not in r.key)  # no URL has such a host or path
    lengths = F.array(*[F.lit(n) for n in sorted({len(r.path) for r in rules})]).cast("array<int>")
    keys = url_keys(F.col("host"), F.col("path"), lengths)
    unwanted = {_LABEL + label for label in spam_hosts if label}
    if unwanted:
        keys = F.concat(keys, label_keys(F.col("host")))
    block = {r.key for r in rules if r.action == "block"}
    lists = {"block": block | unwanted, "allow": {r.key for r in rules if r.action == "allow"} - block}
    if all(len(own) * 40 <= max_bytes * 8 for own in lists.values()):
        universe = stored(rows.select(F.explode_outer(keys).alias("k")).select("k.key").where(
            F.col("key").isNotNull()).distinct(), "url-universe")
        cascades = [Cascade.build(universe, _list(spark, own), 100 * n) for n, own in enumerate(lists.values())]
        return _by_filters(rows, keys, cascades)
    keyed = rows.select("host", "path").distinct().select(
        "host", "path", F.explode_outer(keys).alias("k")
    ).select("host", "path", "k.key", "k.size").where(F.col("key").isNotNull())
    keyed = stored(keyed, "url-keys")
    universe = keyed.select("key").distinct()
    marked = keyed
    for salt, (action, keys) in enumerate(lists.items()):
        listed = _list(spark, keys)
        if len(keys) * 40 > max_bytes * 8:
            marked = marked.join(listed.withColumn(action, F.lit(True)), "key", "left").fillna(False, [action])
        else:
            marked = Cascade.build(universe, listed, 100 * salt).member(marked, action)
    best = marked.where("block OR allow").groupBy("host", "path").agg(
        F.max(F.struct("size", "key", F.when(F.col("block"), "block").otherwise("allow").alias("action"))).alias("best")
    ).select(
        "host", "path", F.when(F.col("best.size") >= 0, F.col("best.key")).alias("rule"), F.col("best.action").alias("action")
    )
    return rows.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("action", F.lit("allow")).alias("verdict"),
    )
