"""Removal of long repeated word passages by difference-cover anchors (operator 13).

A word goes if it lies in a window of ``SIZE`` words that also starts in a document with a
smaller id. Only windows of ``ANCHOR`` words that start at the places ``COVER`` modulo
``PERIOD`` are hashed: any two places have a shift below PERIOD that takes both to such
places, so two equal windows share one of these anchors at the same shift, and SIZE is
ANCHOR + PERIOD - 1. Equal anchors are then extended to the windows around them:

1. *Contexts.* An anchor carries a hash of all words its windows cover (its context). Of
   equal contexts those with a larger id than the least go as a whole. Exact copies and the
   inside of repeated passages are settled by this, without moving text.
2. *Extension.* Where an anchor repeats within different contexts, as at the edges of
   passages and around changed words, the document is read again and extended from the
   anchor word by word to each window that holds it; of equal windows (128 bits of two hashes
   of the words), those with a larger id than the least go.

Every step settles what a batch of rows can settle by itself first and sends on one document per
anchor and context, or per window, so a passage in a third of all documents costs one row a batch.
Anchors that a batch finds in several contexts are dealt by context, with a mark for the anchor.

Null texts have no words. Documents with the same id, as repeated rows, do not remove each
other's words; a missing id counts as the greatest. Ids are whole numbers. Other columns are
not looked at. A text's words and ranges must fit a worker's memory, and are hashed in parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemart.llm.common import stored, text_of

SIZE, PERIOD = 50, 31
#: A perfect difference set: each shift modulo 31 is the difference of exactly one pair.
COVER = (1, 5, 11, 24, 25, 27)
ANCHOR, SIDE = SIZE - PERIOD + 1, PERIOD - 1
_PART = 1 << 16
_KNOWN_WORDS = 1 << 20
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_SETTLED, _LONE, _MARK, _MIXED = 0, 1, 2, 3
_NO_ID = (1 << 63) - 1

_tables: dict[str, np.ndarray] = {}


class _Hashes(dict):
    """64-bit hashes of words, as signed numbers; each word is hashed when first seen."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word) - (1 << 63)
        self[word] = found
        return found


_hashes = _Hashes()


def words_of(text: bytes) -> np.ndarray:
    """Hashes of the words of a text; ``bytes.split`` cuts at exactly the six ASCII blanks."""
    if len(_hashes) > _KNOWN_WORDS:
        _hashes.clear()
    return np.array(list(map(_hashes.__getitem__, text.split())), np.int64).view(np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(which: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, modulo 2^64."""
    if f"up{which}" not in _tables:
        for name, base in (("up", _BASES[which]), ("down", pow(_BASES[which], -1, 1 << 64))):
            powers = np.full(_PART + 2 * SIZE + 1, base, np.uint64)
            powers[0] = 1
            _tables[f"{name}{which}"] = np.multiply.accumulate(powers)
    return _tables[f"up{which}"], _tables[f"down{which}"]


def _spans(words: np.ndarray, which: int, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the word sequences from ``first`` to ``end``, by one of two independent bases."""
    up, down = _powers(which)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum((_mixed(words) if which else words) * down[: len(words)], out=sums[1:])
    return _mixed((sums[end] - sums[first]) * up[first])


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor's hash, context's hash and place of a document's anchors."""
    n, found = len(words), []
    covered = np.zeros(PERIOD, bool)
    covered[list(COVER)] = True
    for at in range(0, n - ANCHOR + 1 if n >= SIZE else 0, _PART):
        last = min(at + _PART, n - ANCHOR + 1)
        places = np.arange(at, last)
        places = places[covered[places % PERIOD]]
        first, end = np.maximum(places - SIDE, 0), np.minimum(places + ANCHOR + SIDE, n)
        low = max(at - SIDE, 0)
        part = words[low : min(last + ANCHOR + SIDE, n)]
        anchor = _spans(part, 0, places - low, places - low + ANCHOR)
        shape = ((places - first) << 8 | (end - first)).astype(np.uint64)
        context = _spans(part, 1, first - low, end - low) + _mixed(shape * np.uint64(_BASES[0]))
        found.append((anchor, context, places))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found))


def windows(words: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both hashes and the start of every window that holds an anchor at one of ``places``."""
    n = len(words)
    wanted = np.zeros(n + 1, np.int64)
    np.add.at(wanted, np.maximum(places - SIDE, 0), 1)
    np.add.at(wanted, np.minimum(places, n - SIZE) + 1, -1)
    starts = np.flatnonzero(np.cumsum(wanted)[: n - SIZE + 1] > 0)
    found = []
    for at in range(0, n, _PART):
        own = starts[(starts >= at) & (starts < at + _PART)]
        part = words[at : at + _PART + SIZE]
        found.append((*(_spans(part, k, own - at, own - at + SIZE) for k in (0, 1)), own))
    return tuple(np.concatenate(c) for c in zip(*found))


def _classes(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys, and the starts of equal ones in that order."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    return order, np.flatnonzero(new)


def _sizes(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(starts, n))


def _ranges(owner: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ranges of each owner, those that touch joined."""
    if not len(owner):
        return owner, first, end
    order = np.lexsort((first, owner))
    owner, first, end = owner[order], first[order], end[order]
    # The furthest end so far, within an owner: owners are lifted apart.
    lift = owner * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift) - lift
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (first[1:] > reach[:-1])
    starts = np.flatnonzero(new)
    return owner[starts], first[starts], np.maximum.reduceat(end, starts)


_ROW = "kind int, anchor long, context long, place long, id long, h long, first long, end long"


def _rows(kind, anchor, context, place, ids, h, first, end) -> pa.RecordBatch:
    columns = [pa.array(np.asarray(kind, np.int32))]
    for c in (anchor, context, place, ids, h, first, end):
        columns.append(pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64)))
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _ROW.split(", ")])


def _around(places: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of the contexts at ``places`` of documents with that many words."""
    return np.maximum(places - SIDE, 0), np.minimum(places + ANCHOR + SIDE, words)


def _settled(ids: np.ndarray, h: np.ndarray, first: np.ndarray, end: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of the ranges that are known to go."""
    if not len(ids):
        return
    order, starts = _classes(ids, h)
    owner = np.repeat(np.arange(len(starts)), _sizes(starts, len(order)))
    lead = order[starts]
    owner, first, end = _ranges(owner, first[order], end[order])
    none = np.zeros(len(owner), np.int64)
    yield _rows(np.full(len(owner), _SETTLED), none, none, none, ids[lead[owner]], h[lead[owner]], first, end)


def _least(values: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each row the least value of its class."""
    out = np.empty(len(order), values.dtype)
    out[order] = np.repeat(np.minimum.reduceat(values[order], starts), _sizes(starts, len(order)))
    return out


def _differ(values: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each row whether its class has different values."""
    return _least(values, order, starts) != ~_least(~values, order, starts)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors (id, h, text) of documents, with what the batch settles by itself."""
    for batch in batches:
        all_ids, all_h = (batch.column(c).to_numpy() for c in (0, 1))
        parts, lengths = [], []
        for text in batch.column(2).cast(pa.binary()).to_pylist():
            words = words_of(text)
            parts.append(anchors(words))
            lengths.append(len(words))
        owner = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        if not len(owner):
            continue
        anchor, context, place = (np.concatenate(c) for c in zip(*parts))
        ids, h = all_ids[owner], all_h[owner]
        first, end = _around(place, np.array(lengths)[owner])
        order, starts = _classes(anchor, context)
        gone = ids > _least(ids, order, starts)
        yield from _settled(ids[gone], h[gone], first[gone], end[gone])
        by_anchor, groups = _classes(anchor)
        mixed = _differ(context, by_anchor, groups) & _differ(ids, by_anchor, groups)
        stay = np.flatnonzero(~gone)
        marks = by_anchor[groups]
        marks = marks[mixed[marks]]
        take = np.concatenate([stay, marks])
        kind = np.concatenate([np.where(mixed[stay], _MIXED, _LONE), np.full(len(marks), _MARK)])
        yield _rows(kind, *(c[take] for c in (anchor, context, place, ids, h, first, end)))


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition's anchors: ranges that go, and anchors whose windows must be compared (mixed)."""
    batches = list(batches)
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    columns = [table[c.split()[0]].to_numpy() for c in _ROW.split(", ")]
    kind = columns[0]
    for kinds in ((_LONE, _MARK), (_MIXED,)):
        own = np.flatnonzero(np.isin(kind, kinds))
        if not len(own):
            continue
        _, anchor, context, place, ids, h, first, end = (c[own] for c in columns)
        mark = kind[own] == _MARK
        # A mark stands for the anchor only, so it has no part in a class of contexts.
        least = np.where(mark, _NO_ID, ids)
        order, starts = _classes(anchor, context)
        gone = ~mark & (ids > _least(least, order, starts))
        wanted = ~mark & ~gone
        if kinds != (_MIXED,):
            by_anchor, groups = _classes(anchor)
            several = _differ(context, by_anchor, groups) & _differ(ids, by_anchor, groups)
            wanted &= several | (_least(-mark.astype(int), by_anchor, groups) < 0)
        yield from _settled(ids[gone], h[gone], first[gone], end[gone])
        yield _rows(np.full(int(wanted.sum()), _MIXED), *(c[wanted] for c in (anchor, context, place, ids, h, first, end)))
    done = np.flatnonzero(kind == _SETTLED)
    if len(done):
        yield from _settled(*(columns[k][done] for k in (4, 5, 6, 7)))


_WINDOW = "gone boolean, one long, two long, id long, h long, first long, end long"


def _window_rows(gone: bool, one, two, ids, h, first, end) -> pa.RecordBatch:
    columns = [pa.array(np.full(len(ids), gone))]
    for c in (one, two, ids, h, first, end):
        columns.append(pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64)))
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _WINDOW.split(", ")])


def _decided(one, two, ids, h, start, keep: bool) -> Iterator[pa.RecordBatch]:
    """Ranges of the windows with a smaller id among the rows and, if asked for, the other windows."""
    if not len(ids):
        return
    order, starts = _classes(one, two)
    gone = ids > _least(ids, order, starts)
    for part in _settled(ids[gone], h[gone], start[gone], start[gone] + SIZE):
        none = np.zeros(len(part), np.int64)
        yield _window_rows(True, none, none, *(part[c].to_numpy() for c in ("id", "h", "first", "end")))
    if keep:
        stay = ~gone
        yield _window_rows(False, one[stay], two[stay], ids[stay], h[stay], start[stay], start[stay] + SIZE)


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows around the wanted anchors of documents (id, h, text, places)."""
    for batch in batches:
        ids, h = (batch.column(c).to_numpy() for c in (0, 1))
        parts = [
            windows(words_of(text), np.array(places, np.int64))
            for text, places in zip(batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist())
        ]
        if not parts:
            continue
        owner = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        one, two, start = (np.concatenate(c) for c in zip(*parts))
        yield from _decided(one, two, ids[owner], h[owner], start, keep=True)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batches = list(batches)
    if batches:
        table = pa.Table.from_batches(batches)
        yield from _decided(*(table[c].to_numpy() for c in ("one", "two", "id", "h", "first")), keep=False)


def repeated_ranges(rows: DataFrame) -> DataFrame:
    """(id, h, first, end): ranges of words that go, of ``rows`` (id, h, text)."""
    scanned = rows.mapInArrow(_scan, _ROW)
    by = F.when(F.col("kind") == _SETTLED, F.xxhash64("id", "h")).when(
        F.col("kind") == _MIXED, F.xxhash64("anchor", "context")).otherwise(F.xxhash64("anchor"))
    settled = stored(scanned.repartition(by).mapInArrow(_settle, _ROW), "cover-anchors")
    wanted = settled.where(F.col("kind") == _MIXED).groupBy("id", "h").agg(F.collect_set("place").alias("places"))
    read = rows.join(wanted, ["id", "h"]).select("id", "h", "text", "places")
    extended = stored(read.mapInArrow(_extend, _WINDOW), "cover-windows")
    compared = extended.where("NOT gone").repartition(F.xxhash64("one")).mapInArrow(_compare, _WINDOW)
    columns = ["id", "h", "first", "end"]
    return settled.where(F.col("kind") == _SETTLED).select(*columns).union(
        extended.where("gone").select(*columns)).union(compared.select(*columns))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[tuple[int, int, bytes]]]]:
    """Ids, and the number of words, of removed words and the kept text of documents (id, text, ranges)."""
    for batch in batches:
        out = []
        for text, ranges in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
            words = text.split()
            n = len(words)
            for r in sorted(ranges or (), key=lambda r: -r["first"]):
                words[r["first"] : r["end"]] = [None] * (min(r["end"], n) - r["first"])
            left = [w for w in words if w is not None] if ranges else words
            out.append((n, n - len(left), b" ".join(left)))
        yield batch.column(0), out


def _with_ranges(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("id"),
        F.xxhash64(text_of(text)).alias("h"), text_of(text).alias("text"))
    ranges = repeated_ranges(rows.select("id", "h", "text")).groupBy("id", "h").agg(
        F.collect_set(F.struct("first", "end")).alias("ranges"))
    return rows.join(ranges, ["id", "h"], "left").select("doc_id", "text", "ranges")


def without_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): documents with their repeated passages cut out."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, rows in _kept(batches):
            numbers = [pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)]
            kept = pa.array([r[2] for r in rows], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([ids, *numbers, kept], ["doc_id", "n_words", "n_removed", "kept"])

    key = docs.schema[doc_id].dataType.simpleString()
    return _with_ranges(docs, doc_id, text).mapInArrow(cut, f"doc_id {key}, n_words long, n_removed long, kept string")


def digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``without_passages``, with the SHA-256 of the kept text in its place."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, rows in _kept(batches):
            numbers = [pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)]
            kept = pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string())
            yield pa.RecordBatch.from_arrays([ids, *numbers, kept], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    key = docs.schema[doc_id].dataType.simpleString()
    return _with_ranges(docs, doc_id, text).mapInArrow(
        cut, f"doc_id {key}, n_words long, n_removed long, kept_sha256 string")
