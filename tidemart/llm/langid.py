"""Language identification by nearest centroids (operator 1).

A text becomes a TF-IDF vector over hashed character 1- to 3-grams, of unit length. Each
language has several centroids, found by spherical k-means over a bounded sample of labelled
texts; a text gets the language of the centroid with the greatest cosine. Texts that are
farther from every centroid than learnt for their length are rejected.

The classifier is fitted on at most ``PER_LANGUAGE`` labelled texts per language, those with
the least hash of their id and, of the same id, of the text; prediction reads every text whole. Vectors of long texts are
summed over slices, so memory does not grow with the text.

Texts that are null or hold no letter are ``und`` with score 0, and rejected. Without
labelled rows every text is ``und``. Ties go to the language that sorts first. Repeated rows
get equal rows. Rows without a label or an id are not learnt from.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.llm.common import text_of

BUCKETS = 1 << 13
PER_LANGUAGE = 400
CENTROIDS = 4
UNKNOWN = "und"
_SLICE = 1 << 19
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)], bool))
    return _letters[0]


_letters: list[np.ndarray] = []


def gram_counts(text: str) -> np.ndarray:
    """Counts of the text's letter n-grams by hash; runs of other characters count as a space.

    A long text is counted in slices: a slice counts the n-grams that end in it.
    """
    total = np.zeros(BUCKETS, np.int64)
    letters = _letter_table()
    text = text.lower()
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    carry, after_letter = np.zeros(0, np.uint32), False
    for at in range(0, len(text), _SLICE):
        codes = np.frombuffer(text[at : at + _SLICE].encode("utf-32-le", "replace"), np.uint32)
        is_letter = letters[codes]
        keep = is_letter.copy()
        keep[1:] |= is_letter[:-1]
        keep[0] |= after_letter
        after_letter = bool(is_letter[-1])
        codes = np.concatenate([carry, np.where(is_letter, codes, np.uint32(32))[keep]])
        old = len(carry)
        one = codes * _MIX[0]
        two = (one[:-1] ^ (codes[1:] * _MIX[1])) * _MIX[2]
        three = (two[:-1] ^ (codes[2:] * _MIX[0])) * _MIX[1]
        for length, grams in enumerate((one, two, three), 1):
            total += np.bincount(grams[max(old - length + 1, 0) :] >> shift, minlength=BUCKETS)
        carry = codes[-2:]
    return total


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass(frozen=True)
class Model:
    """``centroids`` has a unit row per cluster, ``owners`` its language's place in ``languages``.

    ``floors[k]`` is the least accepted cosine of texts with 2^k to 2^(k+1) grams.
    """

    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owners: np.ndarray
    floors: np.ndarray

    def vector(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places = np.flatnonzero(counts)
        weights = (1 + np.log(counts[places])) * self.idf[places]
        return places, (weights / max(np.linalg.norm(weights), 1e-9)).astype(np.float32)

    def nearest(self, text: str | None) -> tuple[str, float, bool]:
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        counts = gram_counts(text)
        places, weights = self.vector(counts)
        cosines = self.centroids[:, places] @ weights
        best = int(np.argmax(cosines))
        score = float(min(1.0, max(0.0, cosines[best])))
        floor = self.floors[min(int(counts.sum()).bit_length() - 1, len(self.floors) - 1)]
        return self.languages[self.owners[best]], score, score < floor


def clusters(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of unit vectors by spherical k-means, started from far-apart rows."""
    chosen = [int(np.argmax(vectors @ vectors.mean(0)))]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(int(np.argmin((vectors @ vectors[chosen].T).max(1))))
    centres = vectors[chosen]
    for _ in range(rounds):
        member = np.argmax(vectors @ centres.T, 1)
        sums = np.stack([vectors[member == c].sum(0) for c in range(len(centres))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-9), centres)
    return centres.astype(np.float32)


def held_out(doc_id: str = "doc_id") -> Column:
    """The part of the documents that is never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fit(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang",
    per_language: int = PER_LANGUAGE, k: int = CENTROIDS,
) -> Model:
    """Learn from a bounded sample: ``per_language`` texts of each label, by hash of their id.

    A text is learnt under the labels of its own rows, once each, however often its row or its id
    repeats; what comes to the driver is at most ``per_language`` texts' counts per label.
    """
    usable = docs.where(
        F.col(label).isNotNull() & F.col(doc_id).isNotNull() & F.col(text).isNotNull() & ~held_out(doc_id)
    ).select(F.col(doc_id).alias("id"), F.col(label).alias("label"), F.col(text).alias("text"))
    hashed = F.xxhash64("text").alias("h")
    keys = usable.select("id", "label", hashed).dropDuplicates()
    order = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id", "h")
    some = keys.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language).drop("n")
    # Bounded by per_language and the labels; rows that are alike in all three come once.
    texts = usable.select("*", hashed).join(F.broadcast(some), ["id", "label", "h"]).groupBy("id", "label", "h").agg(
        F.first("text").alias("text"))

    def grams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts = [gram_counts(t) if has_letter(t) else None for t in frame["text"]]
            keys = zip(frame["id"].astype(str), frame["label"], frame["h"])
            rows = [(*key, np.flatnonzero(c), c[c > 0]) for key, c in zip(keys, counts) if c is not None]
            yield pd.DataFrame(rows, columns=["id", "label", "h", "places", "counts"])

    sample = texts.mapInPandas(grams, "id string, label string, h long, places array<long>, counts array<long>")
    rows = sample.toPandas().sort_values(["label", "id", "h"], kind="stable").reset_index(drop=True)
    return _fitted(rows, k)


def _fitted(rows: pd.DataFrame, k: int) -> Model:
    languages = sorted(rows["label"].unique())
    n = len(rows)
    seen = np.zeros(BUCKETS)
    for places in rows["places"]:
        seen[places] += 1
    idf = np.log((1 + n) / (1 + seen)) + 1
    empty = Model(languages, idf, np.zeros((0, BUCKETS), np.float32), np.zeros(0, int), np.zeros(1))
    vectors = np.zeros((n, BUCKETS), np.float32)
    sizes = np.zeros(n, int)
    for at, (places, counts) in enumerate(zip(rows["places"], map(np.asarray, rows["counts"]))):
        sizes[at] = counts.sum()
        full = np.zeros(BUCKETS, np.int64)
        full[places] = counts
        own, weights = empty.vector(full)
        vectors[at, own] = weights
    centres, owners = [empty.centroids], []
    for place, language in enumerate(languages):
        found = clusters(vectors[(rows["label"] == language).to_numpy()], k)
        centres.append(found)
        owners += [place] * len(found)
    centroids = np.concatenate(centres)
    best = (vectors @ centroids.T).max(1) if n and len(centroids) else np.zeros(n)
    return Model(languages, idf, centroids, np.array(owners, int), _floors(best, sizes))


def _floors(best: np.ndarray, sizes: np.ndarray, bins: int = 40) -> np.ndarray:
    """A third of the cosine that all but the farthest 1 % reach, for texts of a length or shorter.

    Short texts have few grams and lie far from any centroid, so the floor falls with the
    length; lengths that the sample lacks take the floor of the nearest shorter one.
    """
    floors, last = np.zeros(bins), math.nan
    lengths = np.array([int(s).bit_length() - 1 for s in sizes], int)
    for k in range(bins):
        own = best[lengths == k]
        if len(own) >= 10:
            own_floor = float(np.quantile(own, 0.01)) / 3
            last = own_floor if math.isnan(last) else max(last, own_floor)
        floors[k] = 0.0 if math.isnan(last) else last
    return floors


def predict(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """struct(lang_pred, score, rejected) of a text column."""

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def nearest(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.nearest(t) for t in texts], columns=["lang_pred", "score", "rejected"])

    return nearest(text_of(text))


def identified(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang",
    per_language: int = PER_LANGUAGE, k: int = CENTROIDS, into: str = "_lang",
) -> DataFrame:
    """All columns of ``docs`` and ``into``, the prediction of a model fitted on their labels.

    ``into`` must not be a column of ``docs``; ``common.unused`` finds a name that is not.
    """
    model = fit(docs, doc_id, text, label, per_language, k)
    return docs.withColumn(into, predict(docs, model, text))
