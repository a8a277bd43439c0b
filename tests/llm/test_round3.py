"""Operators 11, 12 and 13 on hard cases and against plain loops."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.tables import documents, hard_texts, prose
from tidemart.llm import covers, queries, turns, vantage

VECTORS = "vec_id long, embedding array<double>, label int, cells string, cluster int, distance string"


def vectors_table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 5, "y") for i, v in rows], VECTORS)


def op11(df, **how):
    return sorted(map(tuple, vantage.digest(*vantage.clustered(df, **how)).collect()), key=repr)


def test_clusters_match_plain_loops(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = sorted(map(tuple, queries.op11_vantage_centroids(spark, sf_dir).collect()), key=repr)
    assert got == brute.clusters(rows)


def test_clusters_of_hard_vectors(spark):
    pick = np.random.default_rng(3)
    rows = [(i, [float(x) for x in pick.integers(-3, 3, 64) / 64]) for i in range(60)]
    rows += [(100 + i, [0.25] * 64) for i in range(5)] + [(None, [0.5] * 64), (7, [0.125] * 64), (7, [0.125] * 64)]
    bad = [(200, None), (201, []), (202, [0.1] * 63), (203, [0.1] * 63 + [None]), (204, [0.1] * 63 + [float("nan")]),
           (205, [0.1] * 63 + [float("inf")]), (206, [0.1] * 65)]
    assert op11(vectors_table(spark, rows + bad)) == brute.clusters(rows)
    assert op11(vectors_table(spark, rows[:3])) == brute.clusters(rows[:3])
    assert op11(vectors_table(spark, bad)) == []
    assert op11(vectors_table(spark, rows), k=5, rounds=1) == brute.clusters(rows, k=5, rounds=1)


def test_clusters_of_vectors_too_large_for_64_bits(spark):
    pick = np.random.default_rng(4)
    rows = [(i, [float(x) for x in pick.normal(0, 1, 64)]) for i in range(30)]
    rows += [(50 + i, [float(x) * 1e12 for x in pick.normal(0, 1, 64)]) for i in range(6)]
    rows += [(70 + i, [float(x) * 1e250 for x in pick.normal(0, 1, 64)]) for i in range(3)]
    assert op11(vectors_table(spark, rows), k=6) == brute.clusters(rows, k=6)


@pytest.mark.parametrize("leaf", [1, 2, 5])
def test_tree_finds_nearest_and_least_of_ties(leaf):
    pick = np.random.default_rng(leaf)
    centroids = pick.integers(-4, 4, (40, 3)).tolist()
    tree = vantage.VantageTree(centroids + centroids[:9], leaf)
    points = pick.integers(-6, 6, (500, 3))
    cluster, distance = tree.nearest(points)
    table = ((points[:, None] - np.array(centroids)[None]) ** 2).sum(2)
    assert (cluster == table.argmin(1)).all() and (distance == table.min(1)).all()


def test_tree_prunes():
    """Well separated centroids are not all measured."""
    centroids = [[1000 * (i % 8), 1000 * (i // 8)] for i in range(64)]
    tree = vantage.VantageTree(centroids)
    seen = []
    for node in tree.nodes:
        node.members = _Counting(node.members, seen)
    tree.nearest(np.array([[3010, 4020]]))
    assert 0 < len(seen) < 32


class _Counting(list):
    def __init__(self, own, seen):
        super().__init__(own)
        self.seen = seen

    def __iter__(self):
        for x in list.__iter__(self):
            self.seen.append(x)
            yield x


TURNS = "conv_id long, turn long, role string, text string, kind string, hash string, dropped string, head string"


def turns_table(spark, rows):
    return spark.createDataFrame([(*r, "k", "h", "d", "x") for r in rows], TURNS)


def op12(df):
    rows = turns.damaged(df)
    return sorted(map(tuple, turns.digest(rows, turns.faults(rows)).collect()), key=repr)


def hard_turns():
    pick = np.random.default_rng(8)
    rows = []
    texts = ["Hello there.", "Why?", "no end", "", " \n", "Same.", "Same.", "x!  ", None, "A. B. c"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]
    for conv in range(150):
        for turn in range(int(pick.integers(0, 14))):
            own = int(turn + pick.integers(0, 2)) if pick.random() > 0.1 else None
            rows.append((conv, own, roles[int(pick.integers(0, 9 if conv % 3 else 3))], texts[int(pick.integers(0, 10))]))
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "Yes."), (None, None, None, None)]
    rows += [(900, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(500)]
    rows += [(901, 0, "system", "Be kind.")] * 3
    return rows


def test_repairs_match_plain_dynamic_program(spark):
    rows = hard_turns()
    got = op12(turns_table(spark, rows))
    want = brute.repairs(rows)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == b


def test_repairs_of_the_table_and_of_none(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    assert sorted(map(tuple, queries.op12_turn_repair(spark, sf_dir).collect()), key=repr) == brute.repairs(rows)
    assert op12(df.limit(0)) == []


def test_repair_in_small_batches_and_rows(spark, monkeypatch):
    rows = hard_turns()
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert op12(turns_table(spark, rows)) == brute.repairs(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    hurt = turns.damaged(turns_table(spark, rows))
    made = turns.repaired_rows(hurt, turns.faults(hurt)).orderBy("conv_id", "place").collect()
    lines = {}
    for r in made:
        assert r.place == len(lines.setdefault(r.conv_id, []))
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    for row in brute.repairs(rows):
        assert hashlib.sha256("\n".join(lines.get(row[0], [])).encode()).hexdigest() == row[-1]


def test_block_tables_equal_single_steps():
    table = turns.block_table()
    pick = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 40):
        symbols = pick.integers(0, turns.SYMBOLS - 1, n)
        costs = turns.END
        for s in symbols[::-1].tolist():
            costs = turns.before(s, costs)
        cost, edits = table.repair(symbols)
        assert cost == costs[0]
    assert table.next.shape == (len(table.vectors), turns.SYMBOLS**turns.BLOCK)


def test_cover_meets_every_shift():
    p = covers.PERIOD
    assert {(a - b) % p for a in covers.COVER for b in covers.COVER} == set(range(p))
    assert covers.ANCHOR + p - 1 == covers.SIZE


def op13(df):
    return sorted(map(tuple, covers.digest(df).collect()), key=repr)


def passage_texts():
    shared = prose(11, 130)
    words = shared.split()
    texts = hard_texts() + [shared, prose(12, 33) + " " + shared, shared + "\n" + prose(13, 5)]
    for i in range(40):
        own = list(words)
        own[i * 3] = f"changed{i}"
        texts.append(" ".join(own))
    texts += [" ".join(words[:49]), " ".join(words[:50]), " ".join(words[20:70]) + " end", prose(14, 10) + " " + " ".join(words[60:125])]
    texts += ["same words " * 200, "same words " * 130, "x " + "same words " * 60, prose(15, 3000) + " " + shared + " " + prose(16, 3000)]
    return texts


def test_passages_match_brute_force(spark):
    texts = passage_texts()
    got = op13(documents(spark, texts))
    assert got == sorted(brute.passages(texts, range(1, len(texts) + 1)), key=repr)
    assert sum(r[2] for r in got) > 2000


def test_passages_in_small_batches_and_parts(spark, monkeypatch):
    texts = passage_texts()
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        assert op13(documents(spark, texts).repartition(5)) == sorted(brute.passages(texts, range(1, len(texts) + 1)), key=repr)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    monkeypatch.setattr(covers, "_PART", 97)
    whole = covers.words_of(texts[-1].encode())
    monkeypatch.setattr(covers, "_tables", {})
    small = covers.anchors(whole)
    monkeypatch.setattr(covers, "_PART", 1 << 16)
    monkeypatch.setattr(covers, "_tables", {})
    assert all((a == b).all() for a, b in zip(small, covers.anchors(whole)))


def test_passages_without_ids_rows_or_order(spark):
    text = prose(21, 70)
    docs = documents(spark, [text, text, text])
    bare = docs.withColumn("doc_id", F.when(F.col("doc_id") == 2, F.lit(9)).cast("long"))
    assert sorted(r[2] for r in op13(bare)) == [0, 70, 70]
    same = docs.withColumn("doc_id", F.lit(4).cast("long"))
    assert [r[2] for r in op13(same)] == [0, 0, 0]
    assert op13(docs.limit(0)) == []
    kept = covers.without_passages(docs).orderBy("doc_id").collect()
    assert [r.kept for r in kept] == [text, "", ""]
