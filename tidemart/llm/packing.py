"""Packing of documents into token sequences (operator 9).

Documents are encoded once and cut into pieces of at most ``length`` ids; only the ids' number
and check sum leave the worker. Pieces are dealt at random into groups of bounded size, and
each group is packed by first-fit decreasing: a tournament tree over the bins' free space
finds the first bin with room in logarithmic time. Groups are independent, so they run in
parallel and a lost one is packed again alone.

Null texts are empty and give the end id alone. Repeated rows are packed each. Long texts are
encoded in slices cut at white space, so memory follows the ids, not the words.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemart.llm.common import stored, text_of

LENGTH, END_ID, GROUP = 2048, 1, 4096
_KNOWN_WORDS = 1_000_000
_SLICE = 1 << 20
# White space beyond ASCII, and controls that Python alone counts as white space.
_ODD_SPACE = re.compile("[" + "".join(map(chr, (
    *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
))) + "]")
_ASCII_SPACE = re.compile(r"[ \t\n\x0b\x0c\r]+")
_BEYOND = re.compile("[^\x00-\xff]")
_LATIN = "a-zß-öø-ÿ"
# Pre-tokens of lower-case Latin-1 text: letters and closing marks where nothing else touches
# them, and everything between white space otherwise.
_CUT = re.compile(f"[{_LATIN}]+(?=[\\s.,!?;:]|$)|[.,!?;:]+(?=[\\s{_LATIN}]|$)|\\S+").findall
# The same for ASCII text whose only white space is the six plain characters.
_ASCII_CUT = re.compile(r"[a-z]+(?=[ \t-\r.,!?;:]|\Z)|[.,!?;:]+(?=[ \t-\ra-z]|\Z)|[^ \t-\r]+").findall
_ONE = re.compile(f"[{_LATIN}]+|[.,!?;:]+").fullmatch


class _Known(dict):
    """Ids of words; a word that is not known stands for none and is noted."""

    def __init__(self):
        super().__init__()
        self.new: set[str] = set()
        self.lacked = False

    def __missing__(self, word: str) -> bytes:
        self.new.add(word)
        self.lacked = True
        return b""


class WordEncoder:
    """Ids of texts whose tokenizer drops white space and never looks across it.

    Words are encoded once and kept as bytes of 32-bit ids; texts in Latin-1 are lower-cased and
    cut to pre-tokens first, of which there are fewer, unless lower case makes or hides one of the
    special strings that the tokenizer finds in the raw text. New pre-tokens are encoded together:
    each ends with one token that carries the word-end mark, where the ids are cut. Only texts
    that had new ones are put together again.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith("</w>")
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if not t.normalized]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        self.lowered = sorted({s.lower() for s in special})
        self.known = _Known()

    def _single(self, words: list[str]) -> None:
        for word, e in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False)):
            self.known[word] = np.array(e.ids, "<u4").tobytes()

    def _specials(self, text: str) -> list[tuple[int, str]]:
        return [(m.start(), m[0]) for m in self.special.finditer(text)]

    def _words(self, text: str) -> list[str]:
        if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
            low = text.lower()
            return _ASCII_CUT(low) if not any(s in low for s in self.lowered) else self._with_special(text, low)
        if _ODD_SPACE.search(text):
            return _ASCII_SPACE.split(text)
        # Beyond Latin-1, lower case and composed letters depend on their neighbours.
        if _BEYOND.search(text):
            return text.split()
        low = text.lower()
        return _CUT(low) if not any(s in low for s in self.lowered) else self._with_special(text, low)

    def _with_special(self, text: str, low: str) -> list[str]:
        return _CUT(low) if self._specials(text) == self._specials(low) else text.split()

    def _learn(self, words: set[str]) -> None:
        plain = list(filter(_ONE, words))
        for at in range(0, len(plain), 20_000):
            some = plain[at : at + 20_000]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(cuts) != len(some):
                self._single(some)
                continue
            raw, start = ids.tobytes(), 0
            for word, cut in zip(some, cuts.tolist()):
                self.known[word] = raw[start:cut]
                start = cut
        self._single(list(words.difference(plain)))

    def encode(self, texts: list[str]) -> list[bytes]:
        known = self.known
        if len(known) > _KNOWN_WORDS:
            known.clear()
        known[""] = b""
        find = known.__getitem__
        out, again = [], []
        for text in texts:
            words = self._words(text)
            known.lacked = False
            out.append(b"".join(map(find, words)))
            if known.lacked:
                again.append((len(out) - 1, words))
        if again:
            self._learn(known.new)
            known.new.clear()
            for place, words in again:
                out[place] = b"".join(map(find, words))
        return out


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def slices(text: str, size: int = _SLICE) -> list[str]:
    """The text cut at ASCII white space into parts of about ``size`` characters."""
    if len(text) <= size:
        return [text]
    parts, start = [], 0
    while start < len(text):
        cut = _ASCII_SPACE.search(text, min(start + size, len(text)))
        end = cut.start() if cut else len(text)
        parts.append(text[start : end or len(text)])
        start = max(end, start + 1)
    return parts


def pieces(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): each document cut into pieces."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    key = docs.schema[doc_id].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            owner, out = [], ([], [], [], [])
            at = 0
            while at < len(texts):
                parts, first = [], at
                while at < len(texts) and (not parts or sum(map(len, parts)) < _SLICE):
                    parts.append(texts[at])
                    at += 1
                for place, ids in enumerate(_whole(encoder, parts), first):
                    ids += end
                    n = len(ids) // 4
                    for start in range(0, n, length):
                        own = ids[4 * start : 4 * (start + length)]
                        owner.append(place)
                        for column, value in zip(out, (start, len(own) // 4, zlib.crc32(own), n)):
                            column.append(value)
            columns = [batch.column(0).take(pa.array(owner, pa.int64())), *[pa.array(c, pa.int64()) for c in out]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return rows.mapInArrow(cut, f"doc_id {key}, start long, length long, ids_crc32 long, doc_tokens long")


def _whole(encoder: WordEncoder, texts: list[str]) -> list[bytes]:
    if len(texts) == 1:
        return [b"".join(encoder.encode([part])[0] for part in slices(texts[0]))]
    return encoder.encode(texts)


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset of each item; ties keep their order."""
    n = len(lengths)
    leaves = 1 << max(n - 1, 0).bit_length()
    free = [capacity] * (2 * leaves)  # node k's children are 2k and 2k + 1; most free space below it
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for item in np.argsort(-lengths, kind="stable").tolist():
        size, node = int(lengths[item]), 1
        while node < leaves:
            node *= 2
            if free[node] < size:
                node += 1
        bins[item], offsets[item] = node - leaves, capacity - free[node]
        free[node] -= size
        while node > 1:
            node //= 2
            most = max(free[2 * node], free[2 * node + 1])
            if free[node] == most:
                break
            free[node] = most
    return bins, offsets


def packed(cut: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; about ``group`` pieces are packed together."""
    cut = stored(cut, "pieces")
    groups = max(1, -(-cut.count() // group))
    dealt = cut.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["ids_crc32", "start", "length"], kind="stable")
        bins, offsets = first_fit_decreasing(rows["length"].to_numpy(), length)
        return rows.assign(sequence_id=rows["_group"] * (1 << 24) + bins, offset=offsets).drop(columns="_group")

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return dealt.groupBy("_group").applyInPandas(pack, f"{kinds}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, group: int = GROUP, end_id: int = END_ID,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    return packed(pieces(docs, tokenizer, length, end_id, doc_id, text), length, group)
