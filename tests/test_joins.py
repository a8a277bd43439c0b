import random

import pytest

from tidemart.operators import joins

SIDE = "key string, id long, ts long"


def naive(left, right, lower, upper, how):
    pairs, lone_right = [], set(range(len(right)))
    for a in left:
        hits = [
            n for n, b in enumerate(right)
            if a[0] is not None and a[0] == b[0] and None not in (a[2], b[2])
            and a[2] + lower <= b[2] <= a[2] + upper
        ]
        pairs += [(a[1], right[n][1]) for n in hits]
        lone_right -= set(hits)
        if not hits and how in ("left", "full"):
            pairs.append((a[1], None))
    if how in ("right", "full"):
        pairs += [(None, right[n][1]) for n in lone_right]
    return sorted(pairs, key=str)


def run(spark, left, right, lower, upper, how, **options):
    joined = joins.interval_join(
        spark.createDataFrame(left, SIDE), spark.createDataFrame(right, SIDE),
        {"key": "key"}, ("ts", "ts"), lower, upper, how, **options,
    )
    return sorted(((r.l_id, r.r_id) for r in joined.collect()), key=str)


def random_side(seed, size):
    draw = random.Random(seed)
    return [
        ("hot" if draw.random() < 0.4 else draw.choice(["a", "b", None]), n,
         None if draw.random() < 0.03 else draw.randrange(-3000, 3000))
        for n in range(size)
    ]


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize(("lower", "upper", "width"), [(-50, 50, None), (-90, 5, 95), (0, 0, 1), (7, 40, 10)])
def test_interval_join_is_exact(spark, how, lower, upper, width):
    left, right = random_side(1, 150), random_side(2, 170)
    expected = naive(left, right, lower, upper, how)
    assert run(spark, left, right, lower, upper, how, width=width) == expected
    if how == "inner":
        assert run(spark, left, right, lower, upper, how, width=width, copy="left") == expected


@pytest.mark.parametrize(("at", "hit"), [(5_000, True), (-5_000, True), (5_001, False), (-5_001, False)])
def test_both_ends_count(spark, at, hit):
    found = run(spark, [("k", 1, 0)], [("k", 2, at)], -5_000, 5_000, "inner")
    assert found == ([(1, 2)] if hit else [])


def test_unknown_kind_is_refused(spark):
    with pytest.raises(ValueError):
        run(spark, [("k", 1, 0)], [("k", 2, 0)], -1, 1, "cross")


def test_facts_are_not_broadcast(spark):
    left, right = (spark.createDataFrame([("k", 1, 0)], SIDE) for _ in range(2))
    plan = joins.interval_join(left, right, {"key": "key"}, ("ts", "ts"), -5, 5)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_lookup_passes_unmatched_rows(spark):
    facts = spark.createDataFrame([(1, 7), (2, None), (3, 8)], "id long, sku long")
    dim = spark.createDataFrame([("7", "cup"), ("9", "pot")], "id string, name string")
    found = joins.enrich(facts, dim, "sku", {"sku_name": "name"})
    assert {(r.id, r.sku_name) for r in found.collect()} == {(1, "cup"), (2, None), (3, None)}


def test_lookup_replaces_a_column_of_the_same_name(spark):
    facts = spark.createDataFrame([(1, "old")], "sku long, name string")
    dim = spark.createDataFrame([("1", "new")], "id string, name string")
    assert joins.enrich(facts, dim, "sku", {"name": "name"}).first().name == "new"
