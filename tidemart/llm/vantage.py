"""Clustering of vectors around centroids found through a vantage-point tree (operator 11).

Each round builds a vantage-point tree over the centroids on the driver and sends it to the
tasks. A node holds a centroid as its vantage point and the range of distances from it to
the centroids of either child, so the triangle inequality bounds how near a child's centroids
can be. Every vector searches best first: it takes the open node with the least bound until no
bound is as small as the best distance found. Bounds are floats with a margin and pruning is
inclusive; distances are exact integers, and of equally near centroids the smaller number
wins. The vectors of a batch take their steps together, each with its own open nodes.

Centroids are exact floors of exact sums: each task gives out its sums in limbs of 32 bits,
which Spark adds up, so no order or number of rows changes them and what the driver gets is
bounded by centroids x components x limbs. Vectors are written once as integers; a round reads
only these.

Vectors with another number of components, or with a null or non-finite one, are left out.
Vectors without an id take part but start no centroid. Repeated rows count each, also as starts,
where equal ids go by their vectors. With fewer vectors than ``k`` there are fewer centroids,
without any the result is empty. Centroids that get no vector stay as they are. A distance or
inertia that a long cannot hold is null. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.llm.common import stored

K, ROUNDS, SIZE, SCALE, SEED = 16, 3, 64, 64, 1
_LIMB = 32
_CELLS = 1 << 22
_FAR = np.iinfo(np.int64).max


def _narrow(size: int) -> int:
    """Components below this keep squared distances within 63 bits."""
    return min(1 << 27, math.isqrt((1 << 62) // max(size, 1)) // 2)


@dataclass
class Node:
    """``lows`` and ``highs`` bound the distances from ``vantage`` to each child's centroids."""

    members: list[int] = field(default_factory=list)
    vantage: int = -1
    children: list[int] = field(default_factory=list)
    lows: list[float] = field(default_factory=list)
    highs: list[float] = field(default_factory=list)


class VantageTree:
    """Nodes in one list, the root first; a node without children is a leaf."""

    def __init__(self, centroids: list[list[int]], leaf: int = 2):
        self.exact = any(abs(x) >= _narrow(len(c)) for c in centroids for x in c)
        self.centroids = np.array(centroids, object if self.exact else np.int64).reshape(len(centroids), -1)
        self.nodes: list[Node] = []
        self._build(list(range(len(centroids))), leaf)

    def _build(self, members: list[int], leaf: int) -> int:
        place = len(self.nodes)
        node = Node()
        self.nodes.append(node)
        if len(members) <= leaf:
            node.members = members
            return place
        # The member that is farthest from the first spreads the others most.
        from_first = [(-self._squared(members[0], m), m) for m in members]
        node.vantage = min(from_first)[1]
        others = sorted((self._squared(node.vantage, m), m) for m in members if m != node.vantage)
        half = len(others) // 2
        for part in filter(None, (others[:half], others[half:])):
            node.lows.append(_root(part[0][0]))
            node.highs.append(_root(part[-1][0]))
            node.children.append(self._build([m for _, m in part], leaf))
        return place

    def _squared(self, a: int, b: int) -> int:
        return sum((int(x) - int(y)) ** 2 for x, y in zip(self.centroids[a], self.centroids[b]))

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each row's nearest centroid and the squared distance to it."""
        step = max(1, _CELLS // max(len(self.nodes), 1))
        parts = [self._search(vectors[at : at + step]) for at in range(0, len(vectors), step)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        exact = self.exact or vectors.dtype == object
        n = len(vectors)
        cluster = np.full(n, len(self.centroids), np.int64)
        distance = np.full(n, None, object) if exact else np.full(n, _FAR, np.int64)
        reach = np.full(n, np.inf)  # root of the distance; infinite if exact, so nothing is pruned
        bounds = np.full((n, len(self.nodes)), np.inf)
        bounds[:, 0] = 0.0

        def measure(rows: np.ndarray, centroid: int) -> np.ndarray:
            apart = vectors[rows] - self.centroids[centroid]
            found = (apart * apart).sum(1)
            old = distance[rows]
            if exact:
                nearer = np.array([o is None or f < o or (f == o and centroid < c) for f, o, c in zip(found, old, cluster[rows])], bool)
            else:
                nearer = (found < old) | ((found == old) & (centroid < cluster[rows]))
            better = rows[nearer]
            distance[better], cluster[better] = found[nearer], centroid
            if not exact:
                reach[better] = np.sqrt(found[nearer])
            return found

        while True:
            first = bounds.argmin(1)
            low = bounds[np.arange(n), first]
            open_ = np.flatnonzero((low <= reach) & (low < np.inf))
            if not len(open_):
                return cluster, distance
            bounds[open_, first[open_]] = np.inf
            order = open_[np.argsort(first[open_], kind="stable")]
            edges = np.flatnonzero(np.diff(first[order])) + 1
            for rows in np.split(order, edges):
                node = self.nodes[first[rows[0]]]
                for centroid in node.members:
                    measure(rows, centroid)
                if node.vantage < 0:
                    continue
                found = measure(rows, node.vantage)
                away = np.zeros(len(rows)) if exact else np.sqrt(found)
                for child, lo, hi in zip(node.children, node.lows, node.highs):
                    bound = np.maximum(away - hi, lo - away) - 1e-9 * (1 + away + hi)
                    bounds[rows, child] = 0.0 if exact else np.maximum(np.maximum(bound, low[rows]), 0.0)


def _root(squared: int) -> float:
    return math.sqrt(squared) if squared < 1 << 1000 else math.inf


def _whole(size: int, scale: int):
    """Rows (id, vector) to (id, cells, wide): 32-bit integers, or text where they are too small."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
            small = (np.abs(values) < _narrow(size) / scale - 1).all(1)
            cells = np.floor(np.where(small[:, None], values, 0) * scale).astype("<i4")
            raw = cells.tobytes()
            width = 4 * size
            wide = [None if ok else ",".join(str(_floor(x, scale)) for x in v.tolist()) for ok, v in zip(small, values)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([raw[i * width : (i + 1) * width] if ok else None for i, ok in enumerate(small)], pa.binary()),
                pa.array(wide, pa.string()),
            ], ["vec_id", "cells", "wide"])

    return convert


def _floor(x: float, scale: int) -> int:
    top, bottom = x.as_integer_ratio()
    return top * scale // bottom


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    """The batch's vectors, as objects if one of them is wide."""
    cells, wide = batch.column("cells"), batch.column("wide")
    if wide.null_count == len(wide):
        raw = b"".join(cells.to_pylist())
        return np.frombuffer(raw, "<i4").astype(np.int64).reshape(len(batch), -1)
    rows = [
        np.frombuffer(c, "<i4").tolist() if c is not None else list(map(int, w.split(",")))
        for c, w in zip(cells.to_pylist(), wide.to_pylist())
    ]
    return np.array(rows, object)


def whole_vectors(df: DataFrame, vec_id: str, vector: str, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """The usable vectors as integers floor(scale * x), in the shared folder."""
    key = df.schema[vec_id].dataType.simpleString()
    usable = _usable(df, vec_id, vector, size)
    return stored(usable.mapInArrow(_whole(size, scale), f"vec_id {key}, cells binary, wide string"), "vectors")


def _usable(df: DataFrame, vec_id: str, vector: str, size: int) -> DataFrame:
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return rows.where((F.size("vector") == size) & finite)


def starts(df: DataFrame, vec_id: str, vector: str, k: int = K, size: int = SIZE, scale: int = SCALE, seed: int = SEED) -> list[list[int]]:
    """The ``k`` vectors with the least SHA-256 of ``seed:id``."""
    named = _usable(df, vec_id, vector, size).where(F.col("vec_id").isNotNull())
    first = named.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256), "vector").limit(k)
    return [[_floor(x, scale) for x in row.vector] for row in first.collect()]  # k rows


def _sums(shared: Broadcast):
    """Per task and cluster: limbs of the sums by component; component -1 holds the count."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, total = shared.value, {}
        for batch in batches:
            if not len(batch):
                continue
            vectors = _vectors(batch)
            cluster, _ = tree.nearest(vectors)
            for c in np.unique(cluster).tolist():
                own = vectors[cluster == c]
                row = [len(own), *own.sum(0).tolist()]
                total[c] = [a + b for a, b in zip(total[c], row)] if c in total else row
        out: list[tuple[int, int, int, int]] = []
        for c, row in total.items():
            for place, value in enumerate(row, -1):
                out += [(c, place, limb, part) for limb, part in enumerate(_limbs(value))]
        columns = list(zip(*out)) if out else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["cluster", "place", "limb", "part"])

    return add


def _limbs(value: int) -> list[int]:
    """Digits of 32 bits, the least first; the last one has the sign."""
    found = []
    while not -(1 << _LIMB) < value < 1 << _LIMB:
        found.append(value & (1 << _LIMB) - 1)
        value >>= _LIMB
    return [*found, value]


def _sent(vectors: DataFrame, centroids: list[list[int]]) -> Broadcast:
    """The tree over the centroids; its size is bounded by their number."""
    return vectors.sparkSession.sparkContext.broadcast(VantageTree(centroids))


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: floors of the means of their vectors."""
    parts = vectors.mapInArrow(_sums(_sent(vectors, centroids)), "cluster long, place long, limb long, part long")
    found: dict[int, dict[int, int]] = {}
    for row in parts.groupBy("cluster", "place", "limb").agg(F.sum("part").alias("part")).collect():
        own = found.setdefault(row.cluster, {})
        own[row.place] = own.get(row.place, 0) + (row.part << _LIMB * row.limb)
    return [
        [found[c].get(p, 0) // found[c][-1] for p in range(len(old))] if c in found else old
        for c, old in enumerate(centroids)
    ]


def assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(vec_id, cluster, distance) of each vector's nearest centroid."""
    shared = _sent(vectors, centroids)
    key = vectors.schema["vec_id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        for batch in batches:
            cluster, distance = tree.nearest(_vectors(batch)) if len(batch) else (np.zeros(0, int), np.zeros(0, int))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), pa.array(cluster.astype(np.int32)),
                pa.array([d if d <= _FAR else None for d in distance.tolist()], pa.int64()),
            ], ["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(assign, f"vec_id {key}, cluster int, distance long")


def clustered(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS,
    size: int = SIZE, scale: int = SCALE, seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Assignments (vec_id, cluster, distance), and the ``k`` centroids with their vectors' number and inertia.

    The second table is (cluster, n, inertia, total, centroid); ``total`` is the inertia of all.
    """
    spark: SparkSession = df.sparkSession
    vectors = whole_vectors(df, vec_id, vector, size, scale)
    centroids = starts(df, vec_id, vector, k, size, scale, seed)
    if not centroids:
        none = vectors.limit(0).select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return none, _clusters(spark, [])
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    rows = stored(assigned(vectors, centroids), "assigned")
    whole = F.count("distance") == F.count(F.lit(1))
    inertia = F.when(whole, F.sum(F.col("distance").cast("decimal(38,0)")))
    measured = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), inertia.alias("inertia"))
    found = {r.cluster: (r.n, r.inertia) for r in measured.collect()}  # at most k rows
    every = None if any(i is None for _, i in found.values()) else str(sum(i for _, i in found.values()))
    table = []
    for c, cells in enumerate(centroids):
        n, own = found.get(c, (0, 0))
        table.append((c, n, None if own is None else str(own), every, ",".join(map(str, cells))))
    return rows, _clusters(spark, table)


def _clusters(spark: SparkSession, table: list[tuple]) -> DataFrame:
    found = spark.createDataFrame(table, "cluster int, n long, inertia string, total string, centroid string")
    exact = [F.col(c).cast("decimal(38,0)").alias(c) for c in ("inertia", "total")]
    return found.select("cluster", "n", *exact, "centroid")


def digest(rows: DataFrame, clusters: DataFrame) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per vector."""
    named = clusters.select(
        "cluster", F.expr("try_cast(inertia AS bigint)").alias("cluster_inertia"),
        F.expr("try_cast(total AS bigint)").alias("inertia"), F.sha2("centroid", 256).alias("centroid_sha256"))
    return rows.join(named, "cluster", "left").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
