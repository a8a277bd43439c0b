"""Token counts through distinct pre-tokens (operator 6).

A byte-pair tokenizer looks at one pre-token at a time. So a pre-token's pieces are counted
once per distinct pre-token and joined to the documents' pre-token frequencies; ids are never
kept. Frequencies travel by blocks of documents: one row per block and pre-token, with the
(document, count) pairs as bytes, which moves less than the texts themselves. The join is
by hash of the pre-token; pre-tokens found in many of a block's documents are dealt to
several partitions by block. Sums return to the block sparsely.

Null texts are empty: no tokens. Special strings in texts are tokens, as is the library's
default. Repeated rows are counted each. A block holds at most 65,535 documents and about two
million pairs; one very long text may exceed that alone.

A block's number is its partition and its turn there, so the input must give the same rows
again if a task is repeated, as files and written tables do.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pyarrow.ipc  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemart.llm.common import text_of

_BLOCK_DOCS, _BLOCK_PAIRS = 65_535, 2_000_000
_COMMON, _SALTS = 512, 64
_PLAIN_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
# Texts of these characters alone are cut here; the library cuts all others.
_PLAIN = re.compile(f"[\\t\\n\\x0b\\x0c\\r -~{_PLAIN_LETTERS}¡¿«»–—‘’“”…]*").fullmatch
_CUT = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_PLAIN_LETTERS}]+| ?[0-9]+| ?[^\\s{_PLAIN_LETTERS}0-9]+|\\s+(?!\\S)|\\s+"
).findall

_tokenizers: dict[str, object] = {}


def _tokenizer(path: str):
    if path not in _tokenizers:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


class PreTokens:
    """Cuts texts as a byte-level tokenizer does, special strings apart."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        special.sort(key=len, reverse=True)
        self.special = set(special)
        self.split = re.compile("(" + "|".join(map(re.escape, special)) + ")").split if special else None
        self.marks = re.compile("|".join(map(re.escape, special))).search if special else None

    def __call__(self, text: str) -> Counter:
        if self.marks and self.marks(text):
            total: Counter = Counter()
            for part in self.split(text):
                total.update([part] if part in self.special else self._cut(part))
            return total
        return Counter(self._cut(text))

    def _cut(self, text: str) -> list[str]:
        if _PLAIN(text):
            return _CUT(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]


def _pairs(found: list[tuple[int, int]]) -> bytes:
    """Documents as 16-bit numbers, then counts as bytes; larger counts take several pairs."""
    if any(k > 255 for _, k in found):
        found = [(d, min(255, k - at)) for d, k in found for at in range(0, k, 255)]
    return np.array([d for d, _ in found], "<u2").tobytes() + bytes([k for _, k in found])


def _packed(documents: pa.RecordBatch) -> bytes:
    """The documents of a block as bytes: rows with array columns are costly to hand to Python."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, documents.schema) as writer:
        writer.write_batch(documents)
    return sink.getvalue().to_pybytes()


def token_counts(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) per document."""
    key = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), text_of(text).alias("text"),
        F.octet_length(text_of(text)).cast("long").alias("n_bytes"),
    )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, part = PreTokens(tokenizer), TaskContext.get().partitionId()
        turn = itertools.count()
        found: dict[str, list[tuple[int, int]]] = {}
        ids, sizes, n_docs, n_pairs = [], [], 0, 0

        def out() -> Iterator[pa.RecordBatch]:
            block = part * (1 << 24) + next(turn)
            names, lists = list(found), list(found.values())
            for at in range(0, len(names), 50_000):
                some = names[at : at + 50_000]
                n = len(some)
                yield pa.RecordBatch.from_arrays([
                    pa.array([block] * n, pa.int64()), pa.array(some, pa.string()),
                    pa.array([_pairs(p) for p in lists[at : at + 50_000]], pa.binary()),
                ], names=["block", "piece", "pairs"])
            documents = pa.RecordBatch.from_arrays(
                [pa.concat_arrays(ids), pa.concat_arrays(sizes)], ["doc_id", "n_bytes"])
            yield pa.RecordBatch.from_arrays([
                pa.array([block], pa.int64()), pa.nulls(1, pa.string()), pa.array([_packed(documents)], pa.binary()),
            ], names=["block", "piece", "pairs"])

        for batch in batches:
            first = 0
            for place, body in enumerate(batch.column(1).to_pylist()):
                counts = cut(body)
                for piece, k in counts.items():
                    if piece in found:
                        found[piece].append((n_docs, k))
                    else:
                        found[piece] = [(n_docs, k)]
                n_docs, n_pairs = n_docs + 1, n_pairs + len(counts)
                if n_docs == _BLOCK_DOCS or n_pairs > _BLOCK_PAIRS:
                    ids.append(batch.column(0).slice(first, place + 1 - first))
                    sizes.append(batch.column(2).slice(first, place + 1 - first))
                    yield from out()
                    found, ids, sizes, n_docs, n_pairs, first = {}, [], [], 0, 0, place + 1
            ids.append(batch.column(0).slice(first))
            sizes.append(batch.column(2).slice(first))
        if n_docs:
            yield from out()

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, known = _tokenizer(tokenizer), {}
        totals: dict[int, np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            numbers = list(totals)
            places = [np.flatnonzero(totals[b]) for b in numbers]
            yield pa.RecordBatch.from_arrays([
                pa.array(numbers, pa.int64()),
                pa.array([p.astype("<u2").tobytes() + totals[b][p].astype("<i8").tobytes() for b, p in zip(numbers, places)], pa.binary()),
                pa.array([False] * len(numbers)),
            ], names=["block", "data", "head"])
            totals.clear()

        for batch in batches:
            headers = batch.filter(pa.compute.is_null(batch.column(1)))
            if headers.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [headers.column(0), headers.column(2), pa.array([True] * headers.num_rows)],
                    names=["block", "data", "head"])
            batch = batch.filter(pa.compute.is_valid(batch.column(1)))
            names = batch.column(1).to_pylist()
            new = list(set(names) - known.keys())
            for piece, e in zip(new, tok.encode_batch_fast(new, add_special_tokens=False)):
                known[piece] = len(e.ids)
            n = np.fromiter((known[x] for x in names), np.int64, len(names))
            own = batch.column(0).to_numpy()
            for block in np.unique(own).tolist():
                here = np.flatnonzero(own == block)
                raw = batch.column(2).take(pa.array(here)).to_pylist()
                sizes = np.fromiter((len(r) // 3 for r in raw), np.int64, len(raw))
                docs_of = np.frombuffer(b"".join([r[: 2 * s] for r, s in zip(raw, sizes.tolist())]), "<u2")
                counts = np.frombuffer(b"".join([r[2 * s :] for r, s in zip(raw, sizes.tolist())]), np.uint8)
                worth = np.repeat(n[here], sizes) * counts
                total = totals.setdefault(block, np.zeros(1 << 16, np.int64))
                total += np.bincount(docs_of, worth, 1 << 16).astype(np.int64)
            if len(totals) > 128:
                yield from out()
        if totals:
            yield from out()

    def whole(group: pa.Table) -> pa.Table:
        head = group["head"].to_numpy()
        data = group["data"].to_pylist()
        documents = pa.ipc.open_stream(data[int(np.flatnonzero(head)[0])]).read_all()
        total = np.zeros(1 << 16, np.int64)
        for place in np.flatnonzero(~head).tolist():
            raw = data[place]
            n = len(raw) // 10
            total[np.frombuffer(raw[: 2 * n], "<u2")] += np.frombuffer(raw[2 * n :], "<i8")
        return documents.append_column("n_tokens", pa.array(total[: documents.num_rows], pa.int64()))

    dealt = rows.mapInArrow(blocks, "block long, piece string, pairs binary")
    # Each block's own row lists its documents; it is dealt by block.
    by = F.when(F.col("piece").isNull(), F.xxhash64("block")).when(
        F.octet_length("pairs") > 3 * _COMMON, F.xxhash64("piece", F.col("block") % _SALTS)
    ).otherwise(F.xxhash64("piece"))
    joined = dealt.repartition(by).mapInArrow(sums, "block long, data binary, head boolean")
    return joined.groupBy("block").applyInArrow(whole, f"doc_id {key}, n_bytes long, n_tokens long")
