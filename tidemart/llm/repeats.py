"""Removal of long repeated strings by sorted suffixes (operator 8).

A byte goes if it lies in a string of ``SIZE`` bytes that also starts anywhere else. A suffix
array of the whole corpus would move each text hundreds of times, so only suffixes that can
have an equal are sorted:

1. *Anchors.* In each string of SIZE bytes the least hash of its ``GRAM``-byte substrings is
   its anchor. Equal strings have equal anchors at equal places. An anchor that no other
   place has proves all its strings unique. The anchor and the bytes around it that its
   strings cover (its context) are hashed; where two contexts are equal all their strings
   repeat. This settles exact copies without moving text.
2. *Contexts.* Anchors that repeat within different contexts, as at the edges of a repeated
   passage and in near copies, fetch the contexts' bytes, one per different context.
3. *Sorting.* The contexts of an anchor are sorted by the strings in them: by a multikey
   sort over 8-byte symbols to ``SHALLOW`` bytes, and what is equal so far by blind tries.
   Strings that share a leaf repeat.
4. *Removal.* Repeated strings become ranges of their documents, and are cut out.

Rows that the map side can settle among themselves are settled there, so a passage that a
third of all documents share costs one row per batch. Anchors with over ``CROWDED`` different
contexts are dealt string by string, by the string's hash.

Null texts are empty. Repeated rows repeat each other, and get equal rows. Long texts are
hashed in parts; a text's bytes and ranges must fit a worker's memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemart.llm.common import stored, text_of

SIZE, GRAM, SHALLOW, CROWDED = 200, 50, 24, 1 << 16
#: What a step holds at once: anchors, strings, and bytes of text.
ROWS, STRINGS, BYTES = 1 << 17, 1 << 18, 1 << 24
_PART = (1 << 20) - 512
_BASE = 0x9E3779B97F4A7C15
_SETTLED, _LONE, _MARK, _MIXED = 0, 1, 2, 3

_tables: dict[str, np.ndarray] = {}


def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte value, and the powers of the base and of its inverse."""
    if not _tables:
        random = np.random.default_rng(8)
        _tables["byte"] = random.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            powers = np.full(_PART + SIZE + 1, base, np.uint64)
            powers[0] = 1
            _tables[name] = np.multiply.accumulate(powers)
    return _tables["byte"], _tables["up"], _tables["down"]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def anchors(text: bytes) -> tuple[np.ndarray, ...]:
    """Per run of strings with one anchor: anchor's hash, context's hash, first, last, place.

    ``first`` and ``last`` are the starts of the run's strings, ``place`` the anchor's.
    """
    byte, up, down = _powers()
    found = []
    for at in range(0, max(len(text) - SIZE + 1, 0), _PART):
        part = np.frombuffer(text[at : at + _PART + SIZE - 1], np.uint8)
        n = len(part)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(byte[part] * down[:n], out=sums[1:])
        grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * up[: n - GRAM + 1])
        # The hash's upper bits, then the place: the least is the leftmost of equal hashes.
        keys = (grams & ~np.uint64((1 << 20) - 1)) | np.arange(len(grams), dtype=np.uint64)
        width = SIZE - GRAM + 1
        padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
        padded[: len(keys)] = keys
        grid = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        strings = n - SIZE + 1
        least = np.minimum(behind[:strings], ahead[width - 1 : width - 1 + strings])
        place = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
        change = np.flatnonzero(place[1:] != place[:-1]) + 1
        first = np.concatenate([[0], change])
        last = np.concatenate([change, [strings]]) - 1
        own = place[first]
        end = last + SIZE
        context = _mixed((sums[end] - sums[first]) * up[first]) + _mixed(
            ((own - first) << 20 | (end - first)).astype(np.uint64) * np.uint64(_BASE))
        found.append((grams[own], context, first + at, last + at, own + at))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*found))


def _pieces(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of so many bytes of text; a longer text stands alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        end = max(int(np.searchsorted(ends, before + most, "right")), start + 1)
        yield batch.slice(start, end - start)
        start = end


def _whole_groups(
    batches: Iterator[pa.RecordBatch], weight: Callable[[pa.RecordBatch], int], most: int
) -> Iterator[pa.Table]:
    """Rows sorted by ``route`` in tables that hold all rows of a route, of little over ``most`` where one route has no more."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += weight(batch)
        if size < most or held[0]["route"][0] == batch["route"][-1]:
            continue
        table = pa.Table.from_batches(held)
        route = table["route"].to_numpy()
        cut = int(np.flatnonzero(route != route[-1])[-1]) + 1
        yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
        size = sum(map(weight, held))
    if held:
        yield pa.Table.from_batches(held)


_ANCHOR = "kind int, anchor long, context long, first long, last long, place long, done boolean"


def _runs(anchor: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, ...]:
    """Order by (anchor, context); starts and sizes of equal pairs; each pair's anchor's number."""
    order = np.lexsort((context, anchor))
    a, c = anchor[order], context[order]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
    starts = np.flatnonzero(fresh)
    sizes = np.diff(np.append(starts, len(a)))
    lead = a[starts]
    new = np.ones(len(lead), bool)
    new[1:] = lead[1:] != lead[:-1]
    return order, starts, sizes, np.cumsum(new) - 1


def _rows(columns: tuple[np.ndarray, ...], owners: pa.Array, hashes: pa.Array) -> pa.RecordBatch:
    kind, anchor, context, first, last, place, done = columns
    return pa.RecordBatch.from_arrays([
        pa.array(kind.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)),
        pa.array(first), pa.array(last), pa.array(place), pa.array(done), owners, hashes,
    ], names=["kind", "anchor", "context", "first", "last", "place", "done", "doc_id", "h"])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of a batch of documents, with what the batch settles by itself."""
    for batch in (piece for whole in batches for piece in _pieces(whole, 2, BYTES)):
        texts = batch.column(2).cast(pa.binary()).to_pylist()
        parts = [anchors(t) for t in texts]
        owner = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        if not len(owner):
            continue
        anchor, context, first, last, place = (np.concatenate(c) for c in zip(*parts))
        order, starts, sizes, group = _runs(anchor, context)
        repeated = sizes > 1
        settled = order[np.repeat(repeated, sizes)]
        leader = order[starts]
        mixed = np.bincount(group)[group] > 1
        lead_of_group = np.ones(len(group), bool)
        lead_of_group[1:] = group[1:] != group[:-1]
        marks = leader[mixed & lead_of_group]
        take = np.concatenate([settled, leader, marks])
        kind = np.concatenate([
            np.full(len(settled), _SETTLED), np.where(mixed, _MIXED, _LONE), np.full(len(marks), _MARK)])
        done = np.concatenate([np.ones(len(settled), bool), repeated, np.ones(len(marks), bool)])
        rows = pa.array(owner[take])
        yield _rows(
            (kind, anchor[take], context[take], first[take], last[take], place[take], done),
            batch.column(0).take(rows), batch.column(1).take(rows))


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition's anchors: settled ranges, and one row per context still to be compared.

    The rows come sorted by route; the settled ones have none and come first.
    """
    def open_rows() -> Iterator[pa.RecordBatch]:
        if rest is not None:
            yield rest
        yield from batches

    rest = None
    for batch in batches:
        settled = batch["route"].null_count
        yield batch.slice(0, settled).drop_columns(["route"])
        if settled < batch.num_rows:
            rest = batch.slice(settled)
            break
    for table in _whole_groups(open_rows(), lambda b: b.num_rows, ROWS):
        yield from _settled(table)


def _settled(table: pa.Table) -> Iterator[pa.RecordBatch]:
    kind = table["kind"].to_numpy()
    anchor, context = (table[c].to_numpy().view(np.uint64) for c in ("anchor", "context"))
    done = table["done"].to_numpy()
    keep: list[np.ndarray] = []
    compare: list[np.ndarray] = []
    for kinds in ((_LONE, _MARK), (_MIXED,)):
        own = np.flatnonzero(np.isin(kind, kinds))
        if not len(own):
            continue
        order, starts, sizes, group = _runs(anchor[own], context[own])
        at = own[order]
        marked = np.add.reduceat((kind[at] == _MARK).astype(int), starts)
        real = sizes - marked
        # A range of its own for each of equal contexts that is not settled yet.
        many = np.repeat(real > 1, sizes) & (kind[at] != _MARK)
        keep.append(at[many & ~done[at]])
        leads = at[starts[real > 0]] if not marked.any() else np.array(
            [at[s : s + z][kind[at[s : s + z]] != _MARK][0] for s, z in zip(starts[real > 0], sizes[real > 0])], int)
        done[leads] |= real[real > 0] > 1
        if kinds == (_MIXED,):
            compare.append(leads)
        else:
            groups = group[-1] + 1
            distinct = np.bincount(group, real > 0, groups)
            others = np.bincount(group, marked, groups) > 0
            wanted = (distinct > 1) | others
            compare.append(leads[wanted[group[real > 0]]])
    for label, places in ((_SETTLED, keep), (_MIXED, compare)):
        rows = np.concatenate(places) if places else np.zeros(0, int)
        if not len(rows):
            continue
        some = table.take(pa.array(rows)).combine_chunks()
        columns = [some[c].to_numpy() for c in ("anchor", "context", "first", "last", "place")]
        yield _rows(
            (np.full(len(rows), label), columns[0], columns[1], *columns[2:], done[rows]),
            some["doc_id"].combine_chunks(), some["h"].combine_chunks())


_CONTEXT = "route long, single boolean, offset long, first long, done boolean, bytes binary"


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted contexts; crowded anchors give their strings one by one."""
    for batch in (piece for whole in batches for piece in _pieces(whole, 2, BYTES >> 1)):
        found: list[tuple] = []
        held = 0
        for row, (text, wanted) in enumerate(zip(batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist())):
            for w in wanted:
                own, offset = text[w["first"] : w["last"] + SIZE], w["place"] - w["first"]
                if w["crowded"]:
                    strings = [own[k : k + SIZE] for k in range(len(own) - SIZE + 1)]
                    found.extend(
                        (int.from_bytes(hashlib.blake2b(s, digest_size=8).digest(), "little", signed=True),
                         True, offset - k, w["first"] + k, w["done"], s, row) for k, s in enumerate(strings))
                    held += SIZE * len(strings)
                else:
                    found.append((w["anchor"], False, offset, w["first"], w["done"], own, row))
                    held += len(own)
                if held > BYTES >> 1:
                    yield _contexts(found, batch)
                    found, held = [], 0
        if found:
            yield _contexts(found, batch)


def _contexts(found: list[tuple], batch: pa.RecordBatch) -> pa.RecordBatch:
    *columns, owner = zip(*found)
    rows = pa.array(owner, pa.int64())
    kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [*map(pa.array, columns, kinds), batch.column(0).take(rows), batch.column(1).take(rows)],
        names=["route", "single", "offset", "first", "done", "bytes", "doc_id", "h"])


class BlindTrie:
    """Strings of equal length in order, by a Patricia trie that keeps branching bytes only.

    An inner node is [depth, {byte: node}]; a leaf is a list of the numbers of equal strings.
    """

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: list = [0]
        for number in range(1, len(strings)):
            self._insert(number)

    def _insert(self, number: int) -> None:
        own = self.strings[number]
        node, path = self.root, []
        while type(node[-1]) is dict:  # down without comparing what lies between branches
            path.append(node)
            node = node[1].get(own[node[0]]) or next(iter(node[1].values()))
        other = self.strings[node[0]]
        if own == other:
            node.append(number)
            return
        differ = int.from_bytes(own, "big") ^ int.from_bytes(other, "big")
        depth = len(own) - (differ.bit_length() + 7) // 8
        above = None
        node = self.root
        while type(node[-1]) is dict and node[0] < depth:
            above, node = node, node[1][own[node[0]]]
        if type(node[-1]) is dict and node[0] == depth:
            node[1][own[depth]] = [number]
            return
        branch = [depth, {other[depth]: node, own[depth]: [number]}]
        if above is None:
            self.root = branch
        else:
            above[1][own[above[0]]] = branch

    def leaves(self) -> Iterator[list[int]]:
        """Classes of equal strings, in the strings' order."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if type(node[-1]) is dict:
                stack.extend(node[1][k] for k in sorted(node[1], reverse=True))
            else:
                yield node


def equal_strings(buffer: np.ndarray, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Whether each string of SIZE bytes at ``starts`` has an equal in its group.

    Groups are sorted by 8-byte symbols, only as long as strings tie, down to SHALLOW bytes;
    ties that remain are sorted by blind tries.
    """
    repeated = np.zeros(len(starts), bool)
    order = np.lexsort((starts, group))
    label = group[order]
    for depth in range(0, SHALLOW, 8):
        tie = np.zeros(len(order), bool)
        same = label[1:] == label[:-1]
        tie[1:] |= same
        tie[:-1] |= same
        order, label = order[tie], label[tie]
        if not len(order):
            return repeated
        symbol = np.zeros(len(order), np.uint64)
        for k in range(8):
            symbol = symbol << np.uint64(8) | buffer[starts[order] + depth + k]
        by = np.lexsort((symbol, label))
        order, label, symbol = order[by], label[by], symbol[by]
        new = np.ones(len(order), bool)
        new[1:] = (label[1:] != label[:-1]) | (symbol[1:] != symbol[:-1])
        label = np.cumsum(new)
    whole = buffer.tobytes()
    edges = np.flatnonzero(np.append(np.append(True, label[1:] != label[:-1]), True))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if b - a < 2:
            continue
        strings = [whole[s : s + SIZE] for s in starts[order[a:b]].tolist()]
        if b - a == 2:
            if strings[0] == strings[1]:
                repeated[order[a:b]] = True
            continue
        for leaf in BlindTrie(strings).leaves():
            if len(leaf) > 1:
                repeated[order[a:b][leaf]] = True
    return repeated


def _bounds(binaries: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of binaries, and where each begins and the last one ends."""
    binaries = binaries.cast(pa.binary())
    _, ends, data = binaries.buffers()
    bounds = np.frombuffer(ends, np.int32)[binaries.offset : binaries.offset + len(binaries) + 1]
    return np.frombuffer(data, np.uint8), bounds.astype(np.int64)


def _strings(batch: pa.RecordBatch) -> int:
    """How many strings of SIZE bytes the contexts hold."""
    return pc.sum(pc.binary_length(batch["bytes"])).as_py() - (SIZE - 1) * batch.num_rows


def _sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of the strings that repeat among the contexts of a partition.

    Contexts come first, sorted by route; then the strings of crowded anchors, sorted by route and bytes.
    """
    rest: list[pa.RecordBatch] = []

    def contexts() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.num_rows - (pc.sum(batch["single"]).as_py() or 0)
            if whole:
                yield batch.slice(0, whole)
            if whole < batch.num_rows:
                rest.append(batch.slice(whole))
                return

    for table in _whole_groups(contexts(), _strings, STRINGS):
        yield from _sorted(table)
    yield from _neighbours(chain(rest, batches))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of the single strings that equal the one before or after them; the last waits for the next batch."""
    last, known = None, False
    for batch in batches:
        rows = batch if last is None else pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
        if not rows.num_rows:
            continue
        buffer, bounds = _bounds(rows["bytes"])
        strings = buffer[bounds[0] : bounds[-1]].reshape(-1, SIZE)
        same = (strings[1:] == strings[:-1]).all(1)
        repeated = np.append(same, False)
        repeated[1:] |= same
        repeated[0] |= known
        last, known = rows.slice(len(same)), bool(repeated[-1])
        yield _single_ranges(rows.slice(0, len(same)), repeated[:-1])
    if last is not None:
        yield _single_ranges(last, np.array([known]))


def _single_ranges(rows: pa.RecordBatch, repeated: np.ndarray) -> pa.RecordBatch:
    some = rows.filter(pa.array(repeated & ~rows["done"].to_numpy(zero_copy_only=False)))
    return pa.RecordBatch.from_arrays(
        [some["doc_id"], some["h"], some["first"], pc.add(some["first"], SIZE)], names=["doc_id", "h", "start", "end"])


def _sorted(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Ranges of the strings that repeat within the groups of a table."""
    route, offset, first, done = (table[c].to_numpy() for c in ("route", "offset", "first", "done"))
    buffer, bounds = _bounds(table["bytes"].combine_chunks())
    begin, counts = bounds[:-1], np.diff(bounds) - SIZE + 1
    number = np.cumsum(np.append(False, route[1:] != route[:-1]))
    # Equal strings have their anchor at the same distance, so a few distances at a time will do.
    farthest = int(offset.max())
    edges = np.zeros(farthest + 2, np.int64)
    np.add.at(edges, offset - counts + 1, 1)
    np.add.at(edges, offset + 1, -1)
    there = np.cumsum(edges[:-1])
    low = 0
    while low <= farthest:
        high = max(int(np.searchsorted(np.cumsum(there[low:]), 2 * STRINGS, "right")) + low, low + 1)
        lead, tail = np.maximum(offset - high + 1, 0), np.minimum(offset - low, counts - 1)
        some = np.maximum(tail - lead + 1, 0)
        owner = np.repeat(np.arange(len(some)), some)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(some) - some - lead, some)
        group = number[owner] * (farthest + 1) + offset[owner] - step
        hit = np.flatnonzero(equal_strings(buffer, begin[owner] + step, group) & ~done[owner])
        low = high
        if not len(hit):
            continue
        run = np.ones(len(hit), bool)
        run[1:] = (owner[hit][1:] != owner[hit][:-1]) | (step[hit][1:] != step[hit][:-1] + 1)
        lead = hit[run]
        tail = hit[np.append(run[1:], True)]
        found = table.select(["doc_id", "h"]).take(pa.array(owner[lead]))
        yield pa.RecordBatch.from_arrays([
            found["doc_id"].combine_chunks(), found["h"].combine_chunks(),
            pa.array(first[owner[lead]] + step[lead]), pa.array(first[owner[tail]] + step[tail] + SIZE),
        ], names=["doc_id", "h", "start", "end"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (piece for whole in batches for piece in _pieces(whole, 1, BYTES >> 1)):
        out: list[tuple] = []
        for text, ranges in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
            kept, spans, removed, seen = hashlib.sha256(), 0, 0, 0
            for r in sorted(ranges or (), key=lambda r: r["start"]):
                if r["start"] > seen or not spans:
                    kept.update(text[seen : r["start"]])
                    spans, removed = spans + 1, removed + r["end"] - r["start"]
                    seen = r["end"]
                elif r["end"] > seen:
                    removed, seen = removed + r["end"] - seen, r["end"]
            kept.update(text[seen:])
            out.append((len(text), removed, spans, kept.hexdigest()))
        columns = list(zip(*out)) if out else [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_ranges(rows: DataFrame, key: str, crowded: int = CROWDED) -> DataFrame:
    """(doc_id, h, start, end): the repeated strings of ``rows`` (doc_id, h, text)."""
    shape = f"{_ANCHOR}, doc_id {key}, h long"
    scanned = rows.mapInArrow(_scan, shape)
    over = F.col("kind") == _SETTLED
    group = F.when(F.col("kind") == _MIXED, F.xxhash64("anchor", "context")).otherwise(F.xxhash64("anchor"))
    dealt = scanned.repartition(F.when(over, F.xxhash64("doc_id", "h", "first")).otherwise(group))
    dealt = dealt.withColumn("route", F.when(~over, group)).sortWithinPartitions(F.asc_nulls_first("route"))
    settled = stored(dealt.mapInArrow(_settle, shape), "anchors")
    wanted = settled.where(F.col("kind") == _MIXED)
    crowds = stored(wanted.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > crowded), "crowded")
    marked = wanted.join(crowds.select("anchor", F.lit(True).alias("crowded")), "anchor", "left")
    by_doc = marked.groupBy("doc_id", "h").agg(F.collect_list(F.struct(
        "anchor", "first", "last", "place", "done", F.coalesce("crowded", F.lit(False)).alias("crowded")
    )).alias("wanted")).select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), "wanted")
    fetched = rows.join(
        by_doc, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("h").eqNullSafe(F.col("_h"))
    ).select("doc_id", "h", "text", "wanted").mapInArrow(
        _fetch, f"{_CONTEXT}, doc_id {key}, h long")
    compared = fetched.repartition(F.xxhash64("route")).sortWithinPartitions(
        "single", "route", F.when(F.col("single"), F.col("bytes"))
    ).mapInArrow(_sort, f"doc_id {key}, h long, start long, end long")
    return settled.where(F.col("kind") == _SETTLED).select(
        "doc_id", "h", F.col("first").alias("start"), (F.col("last") + SIZE).alias("end")
    ).union(compared)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", crowded: int = CROWDED) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per document row."""
    key = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text_of(text)).alias("h"), text_of(text).alias("text"))
    ranges = repeated_ranges(rows, key, crowded).groupBy("doc_id", "h").agg(
        F.collect_list(F.struct("start", "end")).alias("ranges")
    ).select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), "ranges")
    joined = rows.join(
        ranges, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("h").eqNullSafe(F.col("_h")), "left")
    return joined.select("doc_id", "text", "ranges").mapInArrow(
        _cut, f"doc_id {key}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
