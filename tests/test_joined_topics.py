"""The join of two topics that keeps its rows in a table: against the batch join, in whole and bounded state."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemart.operators import joins
from tidemart.plans.queries import all_queries
from tidemart.session import fresh_dir, shared_root, stream_session
from tidemart.streaming import joins as stream_joins
from tidemart.streaming import run

SHAPE = "k string, ts long, n long, l_n long"
ON, TIMES = {"k": "k"}, ("ts", "ts")


def sides(size=90):
    """Two sides of rows by time, one of them ahead, with repeated rows, null keys and null times."""
    draw = random.Random(9)
    both = []
    for step in (700, 1_000):
        rows = [(draw.choice(["hot", "hot", "a", None]), n * step + draw.randrange(400), n, n % 3) for n in range(size)]
        both.append(rows + [(k, t if n % 11 else None, n, m) for k, t, n, m in rows[::9]] + rows[::10])
    return both


def batches(spark, rows, parts=4):
    """The rows in order of time as (left, right) frames; those without a time come first."""
    ends = [max(r[1] for r in side if r[1] is not None) for side in rows]
    width = max(ends) // parts + 1
    for part in range(parts):
        yield [spark.createDataFrame([r for r in side if (r[1] or 0) // width == part], SHAPE) for side in rows]


def writer(spark, out, lower, upper, how, **more):
    def write(pairs, batch_id):
        pairs.write.mode("overwrite").parquet(f"{out}/out/batch_id={batch_id}")

    return stream_joins.interval_joining(ON, TIMES, lower, upper, f"{out}/kept", write, how, **more)


def counted(df):
    return sorted((tuple(r) for r in df.drop("batch_id").collect()), key=repr)


@pytest.mark.parametrize("how, lower, upper", [
    ("inner", -2_000, 700), ("left", -2_000, 700), ("right", -900, 3_000), ("full", -1_500, 1_500),
    ("full", 300, 2_500), ("full", -2_500, -300)])
def test_batches_add_up_to_the_batch_join(spark, how, lower, upper):
    rows, out = sides(), fresh_dir(spark, "topics")
    join = writer(spark, out, lower, upper, how)
    for number, pair in enumerate(batches(spark, rows)):
        both = stream_joins.both_topics(*pair)
        for _ in range(1 + number % 2):  # a repeated micro-batch replaces what it wrote
            join(both, number)
    whole = [spark.createDataFrame(side, SHAPE) for side in rows]
    expected = joins.interval_join(*whole, ON, TIMES, lower, upper, how)
    mark = min(max(r[1] for r in side if r[1] is not None) for side in rows)
    left, right = F.col("l_ts"), F.col("r_ts")
    expected = expected.where(
        (left.isNotNull() & right.isNotNull()) | (left < mark - upper) | (right < mark + lower))
    found = spark.read.parquet(f"{out}/out")
    assert found.drop("batch_id").columns == expected.columns
    assert counted(found) == counted(expected) and counted(expected)


def test_only_rows_that_can_meet_a_partner_are_kept(spark):
    out = fresh_dir(spark, "topics")
    join = writer(spark, out, -5, 5, "inner")
    frames = [spark.range(1_000).selectExpr("'k' || id k", "id ts", "id n", "id l_n") for _ in range(2)]
    join(stream_joins.both_topics(*frames), 0)
    assert spark.read.parquet(f"{out}/kept/0/rows").count() == 2 * 6


def test_late_rows_join_nothing_and_rows_behind_by_the_delay_do(spark):
    for delay, pairs in ((0, 1), (20, 2)):
        out = fresh_dir(spark, "topics")
        join = writer(spark, out, -5, 5, "inner", delays=(delay, delay))
        for number, (a, b) in enumerate([([("x", 95, 1, 1), ("x", 100, 2, 1)], [("y", 100, 1, 1)]),
                                         ([("z", 200, 3, 1)], [("x", 99, 2, 1), ("x", 100, 3, 1)])]):
            join(stream_joins.both_topics(spark.createDataFrame(a, SHAPE), spark.createDataFrame(b, SHAPE)), number)
        found = counted(spark.read.parquet(f"{out}/out").groupBy("r_n").count())
        assert found == ([(3, 2)] if pairs == 1 else [(2, 2), (3, 2)])


def test_one_side_alone_is_kept_whole(spark):
    out = fresh_dir(spark, "topics")
    join = writer(spark, out, -5, 5, "full")
    empty, some = spark.createDataFrame([], SHAPE), spark.createDataFrame([("x", 1, 1, 1), ("x", 900, 2, 1)], SHAPE)
    join(stream_joins.both_topics(some, empty), 0)
    join(stream_joins.both_topics(empty, some), 1)
    assert spark.read.parquet(f"{out}/out").count() == 2


def test_stream_over_files_equals_batch(spark):
    rows, out = sides(), fresh_dir(spark, "topics")
    rows = [[r for r in side if r[1] is not None] for side in rows]
    own, streams = stream_session(spark, 4), []
    for n in (0, 1):
        path = f"{out}/in-{n}"
        for pair in batches(spark, rows):
            pair[n].coalesce(1).write.mode("append").parquet(path)
        streams.append(own.readStream.schema(SHAPE).option("maxFilesPerTrigger", 1).parquet(path))
    join = writer(spark, out, -2_000, 700, "inner")
    run.drain_to_batches(stream_joins.both_topics(*streams), join, f"{out}/checkpoint")
    whole = [spark.createDataFrame(side, SHAPE) for side in rows]
    assert counted(spark.read.parquet(f"{out}/out")) == counted(
        joins.interval_join(*whole, ON, TIMES, -2_000, 700))
    assert len(glob.glob(f"{out}/out/batch_id=*")) == 4


@pytest.mark.parametrize("name, folder", [("stream_order_wide", "order-wide"), ("stream_ttl_join_full", "ttl-full")])
def test_no_store_is_asked_for_every_row(spark, sf_dir, name, folder):
    root = shared_root(spark)
    before = set(glob.glob(f"{root}/{folder}-*"))
    assert all_queries()[name](spark, sf_dir).count()
    (base,) = [path for path in set(glob.glob(f"{root}/{folder}-*")) - before if os.path.isdir(f"{path}/checkpoint")]
    assert not os.path.exists(f"{base}/checkpoint/state")
