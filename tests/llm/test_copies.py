"""Operators 5, 6, 8, 9, 10 and the pipeline on hard cases and against brute force."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.compare import connect, difference, duck_rows, spark_rows
from tests.llm import brute
from tests.llm.tables import DOCS, WORDS, documents, hard_texts, prose
from tidemart.llm import decontaminate, packing, queries, repeats, simhash, tokens
from tidemart.llm.components import components
from tidemart.llm.sql import SQL


def near_copies(n, seed=9, words=120):
    base = prose(seed, words).split()
    out = []
    for i in range(n):
        own = list(base)
        own[i % words] = f"changed{i}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, name):
    mine = spark_rows(queries.QUERIES[name](spark, sf_dir))
    assert difference(mine, duck_rows(connect(sf_dir), SQL[name])) is None


def simhash_rows(docs):
    rows = simhash.near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("f"), "component_id").collect()
    return sorted(map(tuple, rows), key=repr)


def test_near_duplicates_match_brute_force(spark):
    texts = hard_texts() + near_copies(60)
    docs = documents(spark, texts)
    assert simhash_rows(docs) == sorted(brute.simhash(texts, range(1, len(texts) + 1)), key=repr)


def test_large_entries_are_split_and_stay_exact(spark, monkeypatch):
    texts = near_copies(90)
    want = sorted(brute.simhash(texts, range(1, 91)), key=repr)
    monkeypatch.setattr(simhash, "LARGEST", 8)
    assert simhash_rows(documents(spark, texts)) == want


def test_links_lose_none_at_the_distance(spark):
    random = np.random.default_rng(5)
    base = random.integers(0, 1 << 63, 40, np.uint64) * np.uint64(2)
    prints = [int(b) for b in base]
    for b in base:
        for k in (1, 4, 5):
            flip = random.choice(64, k, replace=False)
            prints.append(int(b) ^ sum(1 << int(x) for x in flip))
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = {r.node: r.root for r in components(simhash.links(table)).collect()}
    want = brute.components(prints, range(len(prints)))
    got = [roots.get(p, p) for p in signed]
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_chains_in_large_entries_stay_whole(spark):
    """Members reached over others, with the highest bit unset and set, in entries too large for pairs."""
    prints = sorted({top | (1 << k) - 1 << 3 for top in (0, 1 << 63) for k in range(0, 60, 2)}
                    | {1 << 50 | 1 << k for k in range(20)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = simhash.links(table).collect()
    assert found and all(r.a in signed and r.b in signed for r in found)
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= simhash.DISTANCE for r in found)
    roots = {r.node: r.root for r in components(simhash.links(table)).collect()}
    want = brute.components(prints, range(len(prints)))
    got = [roots.get(p, p) for p in signed]
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_near_duplicates_without_ids_or_rows(spark):
    docs = documents(spark, ["same text here now", "same text here now", None])
    bare = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert [r.component_id for r in simhash.near_duplicates(bare).collect()] == [None] * 3
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    n = 300
    edges = spark.createDataFrame([(i * 7919 % n, (i + 1) * 7919 % n) for i in range(n - 1)], "a long, b long")
    assert {r.root for r in components(edges).collect()} == {0}


def encoder():
    from tokenizers import Tokenizer

    return lambda name: Tokenizer.from_file(queries.vocabulary(name))


def test_token_counts_match_the_library(spark):
    library = encoder()("byte_bpe_50k.json")
    texts = hard_texts() + ["the " * 3000, " leading and trailing  ", "a\n\n b\t\tc", "don't I'LL", "<|endoftext|>" * 3]
    rows = tokens.token_counts(documents(spark, texts), queries.vocabulary("byte_bpe_50k.json")).collect()
    want = sorted((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts, 1))
    assert sorted(map(tuple, rows)) == want


def test_token_counts_over_many_blocks(spark, monkeypatch):
    docs = documents(spark, [prose(i, 30) for i in range(50)] + [None] * 3).withColumn(
        "doc_id", F.when(F.col("doc_id") % 9 > 0, F.col("doc_id"))).repartition(3)
    path = queries.vocabulary("byte_bpe_50k.json")
    once = sorted(map(repr, tokens.token_counts(docs, path).collect()))
    monkeypatch.setattr(tokens, "_BLOCK_PAIRS", 100)
    assert sorted(map(repr, tokens.token_counts(docs, path).collect())) == once and len(once) == 53
    assert tokens.token_counts(docs.limit(0), path).count() == 0


def test_packing_keeps_every_id_once_and_without_gaps(spark):
    library = encoder()("word_bpe_49k.json")
    texts = hard_texts() + [prose(i, 400) for i in range(30)]
    docs = documents(spark, texts)
    rows = packing.pack_documents(docs, queries.vocabulary("word_bpe_49k.json"), length=256, group=16).collect()
    ids = [np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for t in texts]
    covered = [np.zeros(len(x), int) for x in ids]
    sequences = {}
    for r in rows:
        own = ids[r.doc_id - 1][r.start : r.start + r.length]
        assert len(own) == r.length and zlib.crc32(own.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id - 1])
        covered[r.doc_id - 1][r.start : r.start + r.length] += 1
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all((c == 1).all() for c in covered)
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256
    assert packing.pack_documents(docs.limit(0), queries.vocabulary("word_bpe_49k.json")).count() == 0


def test_first_fit_decreasing_is_first_fit():
    lengths = np.random.default_rng(1).integers(1, 101, 300)
    bins, _ = packing.first_fit_decreasing(lengths, 100)
    free = []
    for item in np.argsort(-lengths, kind="stable"):
        place = next((k for k, f in enumerate(free) if f >= lengths[item]), len(free))
        if place == len(free):
            free.append(100)
        free[place] -= lengths[item]
        assert bins[item] == place


def test_long_texts_encode_alike_in_slices():
    own = packing.WordEncoder(queries.vocabulary("word_bpe_49k.json"))
    text = prose(3, 3000)
    whole = own.encode([text])[0]
    assert b"".join(own.encode([part])[0] for part in packing.slices(text, 100)) == whole


def removal(docs, **options):
    rows = repeats.without_repeats(docs, **options).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=repr)


REPEATING = [prose(1, 80) + f" own {i} " + prose(50 + i, 20) + " " + prose(2, 60 - i) for i in range(6)]


def test_repeats_match_brute_force(spark):
    texts = hard_texts() + REPEATING + near_copies(12) + ["ab" * 700, "=" * 450, "É" * 130 + prose(1, 80), "x" * 199, "y" * 200]
    want = sorted(((i, *r) for i, r in enumerate(brute.repeats(texts), 1)), key=repr)
    assert removal(documents(spark, texts)) == want
    assert removal(documents(spark, texts).repartition(5)) == want
    assert removal(documents(spark, texts).repartition(5), crowded=2) == want


def test_repeats_in_parts_of_long_texts(spark, monkeypatch):
    texts = [prose(8, 900), prose(9, 700) + prose(8, 900), None]
    want = [r for r in brute.repeats(texts)]
    monkeypatch.setattr(repeats, "_PART", 1500)
    repeats._tables.clear()
    places = [repeats.anchors((t or "").encode()) for t in texts]
    monkeypatch.undo()
    repeats._tables.clear()
    assert all((p[2] <= p[4]).all() and (p[4] + repeats.GRAM <= p[3] * 0 + p[2] + repeats.SIZE + (p[3] - p[2])).all() for p in places)
    assert [r[1:] for r in removal(documents(spark, texts))] == want


def streamed(step, table, key):
    """What a step gives for a table that comes sorted, in batches of ten rows, and the most of these it took at a time."""
    rows = pa.Table.from_pylist(sorted(table.to_pylist(), key=key), table.schema)
    taken, seen, waits, found = 0, 0, [0], []

    def batches():
        nonlocal taken
        for batch in rows.to_batches(max_chunksize=10):
            taken += 1
            yield batch

    for out in step(batches()):
        waits.append(taken - seen)
        seen = taken
        found.append(out)
    return pa.Table.from_batches(found), max(waits), taken


@pytest.mark.parametrize("crowded", [3, 1000])
def test_repeats_hold_few_rows_of_a_partition(monkeypatch, crowded):
    for name, most in (("ROWS", 30), ("STRINGS", 200), ("BYTES", 8000)):
        monkeypatch.setattr(repeats, name, most)
    texts = [(t or "").encode() for t in REPEATING + near_copies(12) + [prose(8, 200)] * 3 + ["x" * 900]]
    docs = pa.RecordBatch.from_pylist([{"doc_id": i, "h": 7, "text": t.decode()} for i, t in enumerate(texts)])
    scanned = pa.Table.from_batches(repeats._scan(iter([docs])))
    routes = [
        None if r["kind"] == repeats._SETTLED else r["anchor"] ^ r["context"] >> 1 if r["kind"] == repeats._MIXED else r["anchor"]
        for r in scanned.to_pylist()]
    settled, wait, batches = streamed(
        repeats._settle, scanned.append_column("route", pa.array(routes, pa.int64())), lambda r: (r["route"] is not None, r["route"] or 0))
    assert wait < 8 < 20 < batches
    spans = [(r["doc_id"], r["first"], r["last"] + repeats.SIZE) for r in settled.to_pylist() if r["kind"] == repeats._SETTLED]
    mixed = [r for r in settled.to_pylist() if r["kind"] == repeats._MIXED]
    sizes = Counter(r["anchor"] for r in mixed)
    wanted = [[r | {"crowded": sizes[r["anchor"]] > crowded} for r in mixed if r["doc_id"] == i] for i in range(len(texts))]
    contexts = list(repeats._fetch(iter([docs.append_column("wanted", pa.array(wanted))])))
    assert len(contexts) > 4 and max(b.nbytes for b in contexts) < 40_000  # one context of single strings at least
    ranges, wait, batches = streamed(
        repeats._sort, pa.Table.from_batches(contexts), lambda r: (r["single"], r["route"], r["bytes"] if r["single"] else b""))
    assert wait < 4 < batches
    spans += [(r["doc_id"], r["start"], r["end"]) for r in ranges.to_pylist()]
    found = [len(set().union(*[range(a, b) for i, a, b in spans if i == n])) for n in range(len(texts))]
    assert found == [r[1] for r in brute.repeats([t.decode() for t in texts])]


def test_repeated_rows_and_no_rows(spark):
    docs = documents(spark, [prose(1, 60)] * 2).withColumn("doc_id", F.lit(None).cast("long"))
    n = len(prose(1, 60))
    assert [r[2] for r in removal(docs)] == [n, n]
    assert removal(docs.limit(0)) == []


def test_blind_trie_sorts():
    random = np.random.default_rng(3)
    strings = [bytes(random.integers(97, 99, 12, np.uint8)) for _ in range(400)]
    leaves = list(repeats.BlindTrie(strings).leaves())
    assert [strings[leaf[0]] for leaf in leaves] == sorted(set(strings))
    assert all(len({strings[i] for i in leaf}) == 1 for leaf in leaves) and sum(map(len, leaves)) == 400


ITEMS = "item_id long, text string, n int, mark long, phrase string"


def test_contamination_matches_brute_force(spark):
    items = [
        (1, prose(21, 40)), (2, prose(22, 12)), (3, "Rare SHORT item"), (4, "single"), (5, None), (6, "  "), (7, prose(21, 40)),
        (None, prose(23, 15)), (8, "la " * 30), (9, "É ÉTÉ ok x y z"),
    ]
    shared = prose(21, 40).split()
    texts = hard_texts() + [
        "x " + " ".join(shared[5:15]) + " y", " ".join(shared[5:14]), " ".join(shared).upper().replace(" ", "\t.."), "a rare short item!",
        prose(23, 15), "la " * 50, "É été ok x y z", "single", prose(30, 200) + " " + prose(22, 12) + " " + " ".join(shared),
    ]
    bench = spark.createDataFrame([(i, t, 1, 2, "p") for i, t in items], ITEMS)
    rows = decontaminate.contamination(documents(spark, texts), bench).orderBy("doc_id").collect()
    got = [(r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) for r in rows]
    assert got == brute.contamination(texts, items)


def test_contamination_of_repeated_rows_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, prose(21, 40), 1, 2, "p")] * 2, ITEMS)
    docs = documents(spark, [prose(21, 40)] * 2).withColumn("doc_id", F.lit(None).cast("long"))
    rows = decontaminate.contamination(docs, bench).collect()
    assert [(r.n_hit, r.n_items) for r in rows] == [(40, 1)] * 2
    assert [r.n_hit for r in decontaminate.contamination(docs, bench.limit(0)).collect()] == [0, 0]
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0


def test_pipeline_decides_stage_by_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, docs, sf_dir)
    assert kept.columns == docs.columns and kept.count() >= 0.98 * docs.count()
    first = stages["near_dedup"](spark, docs, sf_dir)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    want = {i for i, _, root in brute.simhash([t for _, t in texts], [i for i, _ in texts]) if i == root}
    assert {r.doc_id for r in first.collect()} == want and first.columns == docs.columns
    clean = stages["decontaminate"](spark, docs, sf_dir)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    hit = brute.contamination([t for _, t in texts], bench)
    assert {r.doc_id for r in clean.collect()} == {i for (i, _), h in zip(texts, hit) if not h[4]}
    secret = stages["secret_scan"](spark, docs, sf_dir)
    assert secret.columns == docs.columns and secret.count() == docs.count()
    assert all(brute.secrets(r.text)[:3] == (0, 0, 0) for r in secret.collect())


def test_special_strings_in_other_case_are_ordinary_text():
    library = encoder()("word_bpe_49k.json")
    own = packing.WordEncoder(queries.vocabulary("word_bpe_49k.json"))
    texts = [
        "One <|EndOfText|> two", "<|ENDOFTEXT|>", "a<|StartOfText|>b <|endoftext|> C", "<|endoftext|> It's <|ENDOFTEXT|>É", "A <|endoftext|> B",
        "Plain TEXT, é!",
    ]
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_near_copies_with_shared_or_missing_ids_leave_one_each(spark, sf_dir):
    one, two, three = prose(41, 120), prose(42, 120), prose(43, 120)
    given = [
        (1, one), (1, two), (2, one), (1, one), (3, three), (3, three + " "), (None, three), (None, prose(44, 120)),
        (None, prose(44, 120)), (5, prose(45, 120)), (6, prose(45, 120)), (6, prose(46, 120)), (None, None), (None, ""),
    ]
    docs = documents(spark, []).unionByName(spark.createDataFrame(given, "doc_id long, text string"), allowMissingColumns=True)
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    kept = stage(spark, docs.repartition(5), sf_dir)
    rows = [(r.doc_id, (r.text or "").strip()) for r in kept.collect()]
    want = [(1, one), (1, two), (3, three), (None, prose(44, 120)), (5, prose(45, 120)), (6, prose(46, 120)), (None, "")]
    assert sorted(rows, key=repr) == sorted(want, key=repr) and kept.columns == docs.columns


def test_pipeline_survives_hard_rows(spark, sf_dir):
    docs = documents(spark, hard_texts())
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).collect()
        stage(spark, docs.limit(0), sf_dir).collect()


def test_pipeline_runs(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.count() > 0 and "sequence_id" in rows.columns
