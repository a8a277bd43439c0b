"""SimHash near-duplicates through deletion variants (operator 5).

A document's fingerprint has a bit set if it is set in over half of the hashes of its word
shingles. Fingerprints link at ``DISTANCE`` (4) or fewer differing bits. Cut into three
segments, such a pair has one segment that differs in one bit at most. So each fingerprint is
indexed by its three segments and by each segment with one bit wildcarded; fingerprints that
share an entry are compared in full. Three long segments are far more selective than the
five short ones that exact matching needs.

* Equal fingerprints are merged first; copies never meet each other again.
* A pair is compared under the plain segment if its segments are equal, and under a wildcard
  only if it differs in that bit, so no pair meets 20 times.
* Within an entry, small groups are compared pair by pair and larger ones by search from
  member to member, which gives a spanning forest: links grow with the members, not with
  their pairs. A partition gives out a forest of all it found.
* Entries over ``LARGEST`` members are split into blocks, and pairs of blocks are dealt to
  tasks of their own, so no task holds an unbounded entry. All pairs are still covered.

Links that a forest leaves out are implied by those it holds, so components are exact.

A null text has no words and fingerprint zero. Fingerprint zero links like any other. Rows
without an id take part and get the least id of their component, null if there is none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemart.llm.common import stored, text_of
from tidemart.llm.components import components

SHINGLE, DISTANCE, SEED = 4, 4, 42
#: First bit and width of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
LARGEST = 2048
_SEARCH = 16
_WORDS_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text; long texts are hashed in parts of bounded size."""
    import re

    from xxhash import xxh64_intdigest

    words = re.findall(r"[^\x20\x09-\x0D]+", _lower(text))
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    total = np.zeros(64, np.int64)
    for at in range(0, n, _WORDS_AT_ONCE):
        own = words[at : min(at + _WORDS_AT_ONCE, n) + shingle - 1]
        columns = [own[k : len(own) - shingle + 1 + k] for k in range(shingle)] if n > 1 or len(words) == shingle else [[" ".join(words)]]
        hashes = np.array([xxh64_intdigest(" ".join(s), SEED) for s in zip(*columns)], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(0, dtype=np.int64)
    ones = (2 * total > n).astype(np.uint8)
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


_LOWER = {c: c + 32 for c in range(65, 91)}


def _lower(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_LOWER)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    key = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {key}, fp long")


def _entries(fps: np.ndarray) -> np.ndarray:
    """Index keys, a row per fingerprint and a column per entry: segments, then wildcards.

    A key is made of the segment's number, the wildcarded bit (31: none) and the value.
    """
    columns = []
    for number, (first, width) in enumerate(SEGMENTS):
        value = (fps >> np.uint64(first)) & np.uint64((1 << width) - 1)
        columns.append(np.uint64((number << 5 | 31) << 22) | value)
        for bit in range(width):
            columns.append(np.uint64((number << 5 | bit) << 22) | (value & ~np.uint64(1 << bit)))
    return np.stack(columns, 1)


def index(distinct: DataFrame) -> DataFrame:
    """(entry, fp) for every fingerprint and index entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for at in range(0, len(fps), 1 << 13):
                some = fps[at : at + (1 << 13)]
                keys = _entries(some.view(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(some, keys.shape[1]))], ["entry", "fp"])

    return distinct.select("fp").mapInArrow(run, "entry long, fp long")


def _oversized(distinct: DataFrame) -> DataFrame:
    """(entry, blocks) of the entries that may have over LARGEST members.

    Counted by plain segments, three per fingerprint: a wildcard entry is made of two
    segments, so it is large only if one of them has half as many.
    """
    plain = F.array(*[
        F.struct(F.lit(number).alias("number"), F.expr(
            f"shiftrightunsigned(fp, {first}) & {(1 << width) - 1}L").alias("value"))
        for number, (first, width) in enumerate(SEGMENTS)
    ])
    counts = distinct.select(F.explode(plain).alias("s")).groupBy("s").agg(F.count("*").alias("n"))
    large = counts.where(F.col("n") > LARGEST // 2).select("s.number", "s.value", "n")
    bits = F.expr("explode(concat(array(31), sequence(0, case number " + " ".join(
        f"when {number} then {width - 1}" for number, (_, width) in enumerate(SEGMENTS)) + " end)))")
    entries = large.select("number", "value", "n", bits.alias("bit")).select(
        F.expr("((number * 32L + bit) * 4194304L) + if(bit = 31, value, value & ~shiftleft(1L, bit))").alias("entry"), "n"
    )
    # Both segments of a wildcard entry may be large; one that is not has under half.
    return entries.groupBy("entry").agg(
        F.ceil((F.sum("n") + LARGEST // 2) / LARGEST).cast("int").alias("blocks"))


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): a spanning forest of the links among distinct fingerprints, in parts."""
    oversized = stored(_oversized(distinct), "oversized")
    indexed = index(distinct).join(oversized, "entry", "left")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    pairs = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.expr(
        "transform(sequence(0, blocks - 1), j -> least(j, pmod(xxhash64(fp), blocks)) * blocks "
        "+ greatest(j, pmod(xxhash64(fp), blocks)))"
    ))
    dealt = indexed.select("entry", "fp", F.explode_outer(pairs).alias("cell"))
    return dealt.repartition(F.xxhash64("entry", "cell")).select("entry", "cell", "fp").mapInArrow(
        _compare, "a long, b long")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within the entries of one partition, which holds whole cells of entries."""
    parts = [tuple(np.asarray(batch.column(k)) for k in range(3)) for batch in batches]
    if not parts:
        return
    entry, cell, fp = (np.concatenate([p[k] for p in parts]) for k in range(3))
    order = np.lexsort((fp, cell, entry))
    entry, cell, fp = entry[order], cell[order], fp[order].view(np.uint64)
    new = np.ones(len(fp), bool)
    new[1:] = (entry[1:] != entry[:-1]) | (cell[1:] != cell[:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(fp)))
    bit = (entry >> 22) & 31
    shift = np.array([first for first, _ in SEGMENTS], np.int64)[entry >> 27] + bit
    found = []
    # Small groups: each member with the next, the one after it, and so on.
    size_of = np.repeat(sizes, sizes)
    at = np.arange(len(fp)) - np.repeat(starts, sizes)
    for step in range(1, _SEARCH):
        left = np.flatnonzero((size_of <= _SEARCH) & (at + step < size_of))
        if not len(left):
            break
        differ = fp[left] ^ fp[left + step]
        near = np.bitwise_count(differ) <= DISTANCE
        wild = bit[left] != 31
        side = (differ >> np.where(wild, shift[left], 0).astype(np.uint64)) & np.uint64(1)
        left = left[near & (~wild | (side == 1))]
        found.append(np.stack([fp[left], fp[left + step]], 1))
    # Larger ones: from each member to all not yet reached.
    for start in starts[sizes > _SEARCH]:
        end = start + size_of[start]
        rest = np.unique(fp[start:end])
        while len(rest):
            reached, rest = [rest[0]], rest[1:]
            while reached and len(rest):
                member = reached.pop()
                near = np.bitwise_count(rest ^ member) <= DISTANCE
                if near.any():
                    hit = rest[near]
                    found.append(np.stack([np.full(len(hit), member, np.uint64), hit], 1))
                    reached.extend(hit)
                    rest = rest[~near]
    if not found:
        return
    edges = _forest(np.concatenate(found))
    yield pa.RecordBatch.from_arrays(
        [pa.array(edges[:, 0].copy().view(np.int64)), pa.array(edges[:, 1].copy().view(np.int64))], ["a", "b"])


def _forest(edges: np.ndarray) -> np.ndarray:
    """The edges of a spanning forest, by union-find with path halving."""
    nodes, ends = np.unique(edges, return_inverse=True)
    parent = list(range(len(nodes)))
    kept = []
    for number, (a, b) in enumerate(ends.reshape(-1, 2).tolist()):
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append(number)
    return edges[kept]


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) per document row."""
    marked = stored(fingerprints(docs, doc_id, text), "fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(distinct), "fingerprint-links")
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    owner = rooted.join(least, "root").select(F.col("fp").alias("_fp"), "component_id")
    return marked.join(owner, marked["fp"] == owner["_fp"]).select("doc_id", "fp", "component_id")
