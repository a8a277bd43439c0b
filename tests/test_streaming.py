"""Streaming forms over several files against the batch forms."""

import glob
import random

import pyarrow as pa
import pytest
from pyspark.sql import Row, functions as F

from tests.pages import PAGES, frame, page
from tidemart.operators import joins, logs, stats, visits
from tidemart.session import fresh_dir, shared_root, stream_session
from tidemart.streaming import joins as stream_joins
from tidemart.streaming import run, windows
from tidemart.streaming import visits as stream_visits

TIMEOUT = 10_000


def visit_log(size=400, disorder=4_000):
    """Records in arrival order, each at most ``disorder`` late."""
    draw = random.Random(3)
    rows = []
    for n in range(size):
        ts = 1_000_000 + n * 700 - draw.randrange(disorder)
        mid = "hot" if n % 3 == 0 else f"m{draw.randrange(6)}"
        rows.append(page(n, mid, ts, draw.choice([None, "home"]), draw.choice(["0", "1"])))
    return rows


def file_stream(spark, rows, parts=3, idle_batches=True):
    path = fresh_dir(spark, "files")
    size = -(-len(rows) // parts)
    for start in range(0, len(rows), size):
        frame(spark, rows[start:start + size]).coalesce(1).write.mode("append").parquet(path)
    own = stream_session(spark, 4, idle_batches)
    return own.readStream.schema(PAGES).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("salts", [1, 4])
def test_new_flag_by_arrival(spark, salts):
    rows = visit_log()
    fixed = stream_visits.repair_new_flag(file_stream(spark, rows), salts)
    out = run.drained(spark, fixed, "flags")
    assert out.count() == len(rows)
    kept = {r.event_id for r in out.where("common.is_new = '1'").collect()}
    # Files come one by one; within a file the earliest claim counts.
    size, first = -(-len(rows) // 3), {}
    for row in rows:
        if row[1][4] == "1":
            mid, rank = row[1][0], (row[0] // size, row[4], row[0])
            first[mid] = min(first.get(mid, rank), rank)
    assert kept == {rank[2] for rank in first.values()}


def test_repair_equals_batch_when_arrival_is_event_order(spark):
    rows = visit_log(disorder=1)
    streamed = run.drained(spark, stream_visits.repair_new_flag(file_stream(spark, rows)), "flags")
    batch = logs.repair_new_flag(frame(spark, rows))
    same = streamed.select("event_id", "common.is_new").exceptAll(batch.select("event_id", "common.is_new"))
    assert streamed.count() == batch.count() and same.isEmpty()


def test_unique_visits_over_files(spark):
    rows = visit_log()
    for salts in (1, 4):
        found = run.drained(
            spark, stream_visits.unique_visits(file_stream(spark, rows, idle_batches=False), salts=salts), "uv")
        batch = visits.unique_visits(frame(spark, rows))
        assert sorted(r.mid for r in found.select("common.mid").collect()) == sorted(
            r.mid for r in batch.select("common.mid").collect())


def test_bounces_over_files_with_disorder(spark):
    rows = visit_log()
    for width in (None, TIMEOUT):
        stream = stream_visits.bounce_details(
            file_stream(spark, rows), TIMEOUT, "14 seconds", width=width)
        found = {(r.event_id, r.bounce_kind) for r in run.drained(spark, stream, "bounce").collect()}
        closed = max(row[4] for row in rows) - 14_000
        batch = visits.bounce_details(frame(spark, rows), TIMEOUT)
        expected = {(r.event_id, r.bounce_kind) for r in
                    batch.where(F.col("ts") + TIMEOUT <= closed).collect()}
        assert found == expected and expected


def test_bounce_rows_keep_their_fields(spark):
    rows = [page(1, "m", 1_000, shown=2), page(2, "n", 90_000)]
    out = run.drained(
        spark, stream_visits.bounce_details(file_stream(spark, rows, 1), TIMEOUT), "bounce").first()
    assert (out.event_id, out.page.page_id, len(out.displays)) == (1, "home", 2)


def test_windows_over_files_equal_closed_batch_windows(spark):
    rows = visit_log()

    def sums(pages):
        empty = pages.where("false")
        plain = stats.visitor_rows(pages, empty, empty)
        return stats.visitor_stats(plain, "10 seconds", "5 seconds").select("stt", "edt", "is_new", "pv_ct")

    found = run.drained(spark, sums(file_stream(spark, rows)), "windows")
    closed = F.timestamp_millis(F.lit(max(row[4] for row in rows) - 5_000))
    batch = sums(frame(spark, rows)).where(F.to_timestamp("edt") <= closed)
    assert found.count() == batch.count() > 0 and found.exceptAll(batch).isEmpty()


def test_join_over_files_equals_batch(spark):
    draw = random.Random(5)
    sides = []
    for side in range(2):
        rows = [page(n, draw.choice(["hot", "hot", "a"]), 1_000_000 + n * 500) for n in range(120)]
        sides.append(rows)

    def cut(df):
        return df.select(F.col("common.mid").alias("k"), "event_id", "ts")

    def streams():
        own = stream_session(spark, 4)
        for rows in sides:
            path = fresh_dir(spark, "side")
            for part in (rows[:60], rows[60:]):
                frame(spark, part).coalesce(1).write.mode("append").parquet(path)
            yield cut(own.readStream.schema(PAGES).option("maxFilesPerTrigger", 1).parquet(path))

    left, right = streams()
    found = run.drained(spark, stream_joins.interval_join(
        left, right, {"k": "k"}, ("ts", "ts"), -2_000, 700), "join")
    batch = joins.interval_join(
        cut(frame(spark, sides[0])), cut(frame(spark, sides[1])), {"k": "k"}, ("ts", "ts"), -2_000, 700)
    assert found.count() == batch.count() > 0 and found.exceptAll(batch).isEmpty()


def test_lookup_and_routing_on_a_stream(spark):
    rows = [page(n, str(n % 3), 1_000 + n, page_id="home") for n in range(9)]
    users = spark.createDataFrame([("0", "F"), ("1", "M")], "id string, gender string")
    stream = file_stream(spark, rows).select(F.col("common.mid").alias("user_id"), "event_id")
    out = run.drained(spark, joins.enrich(stream, users, "user_id", {"gender": "gender"}), "lookup")
    assert sorted((r.event_id % 3, r.gender) for r in out.collect()) == (
        [(0, "F")] * 3 + [(1, "M")] * 3 + [(2, None)] * 3)


def test_product_sums_over_files_equal_batch(spark):
    rows = [page(n, "m", 1_000_000 + n * 900, item=str(n % 2), page_id="good_detail", shown=n % 3)
            for n in range(90)]

    def sums(pages):
        return stats.product_sums(stats.click_and_display_rows(pages), "10 seconds")

    found = run.drained(spark, sums(file_stream(spark, rows)), "sums")
    closed = F.timestamp_millis(F.lit(rows[-1][4] - 2_000))
    batch = sums(frame(spark, rows)).where(F.to_timestamp("edt") <= closed)
    assert found.count() == batch.count() > 0 and found.exceptAll(batch).isEmpty()


def test_bounce_state_is_freed(spark):
    """Records of slices without an entry leave with their slice."""
    own = stream_session(spark, 2)
    path = fresh_dir(spark, "no-entries")
    schema = frame(spark, []).schema
    checkpoint, out = fresh_dir(spark, "checkpoint"), fresh_dir(spark, "out")
    early = [page(n, f"m{n % 20}", 1_000_000 + n * 50, "home") for n in range(80)]
    late = [page(1000 + n, "other", 1_000_000 + n * 40_000_000, "home") for n in (1, 2, 3)]
    kept = []
    for rows in (early, *[[row] for row in late]):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(path)
        stream = own.readStream.schema(schema).parquet(path)
        found = stream_visits.bounce_details(stream, TIMEOUT)
        query = (
            found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    # Only the last record's own slice is open; the twenty visitors' keys are gone.
    assert kept[0] >= 20 and kept[-1] <= 4


def test_bounces_of_visitors_who_share_a_state(spark):
    rows = visit_log()
    stream = stream_visits.bounce_details(file_stream(spark, rows), TIMEOUT, "14 seconds", groups=1)
    found = {(r.event_id, r.bounce_kind) for r in run.drained(spark, stream, "bounce").collect()}
    closed = max(row[4] for row in rows) - 14_000
    batch = visits.bounce_details(frame(spark, rows), TIMEOUT).where(F.col("ts") + TIMEOUT <= closed)
    assert found == {(r.event_id, r.bounce_kind) for r in batch.collect()} and found


class _Value:
    """A value state that counts writes, and the clock's time of a batch."""

    def __init__(self):
        self.value, self.writes, self.now = None, 0, 0

    def getValueState(self, *_, ttlDurationMs=None):
        return self

    def get(self):
        return self.value

    def exists(self):
        return self.value is not None

    def update(self, value):
        self.value, self.writes = value, self.writes + 1

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_days_of_a_visitor_share_a_state_and_expire_one_by_one():
    finder, state = stream_visits.FirstOfDay(100), _Value()
    finder.init(state)

    def come(now, *days):
        state.now = now
        rows = [Row(mid="m", day=day, at=9 - n, number=n, value=str(n)) for n, day in enumerate(days)]
        return [(r.day, r.number) for r in finder.handleInputRows(("m", 0), iter(rows), state)]

    assert come(0, 1, 2, 1, 3) == [(1, 2), (2, 1), (3, 3)] and state.writes == 1
    assert come(50, 2, 4, 3) == [(4, 1)] and state.writes == 2
    assert come(99, 1, 4) == [] and state.writes == 2
    assert come(100, 1, 4) == [(1, 0)]


def test_an_arrow_batch_keeps_the_first_of_visitor_and_day():
    rows = [("a", 1, 5, 1), ("a", 1, 4, 2), (None, 1, 3, 3), ("b", 2, 1, 9), ("b", 2, 1, 4), (None, 1, 3, 2), ("a", 2, 9, 9)]
    batch = pa.RecordBatch.from_pylist([dict(zip(("mid", "day", "at", "number"), row)) for row in rows])
    found = [tuple(r.values()) for b in stream_visits._first_in_batch(iter([batch, batch[:0]])) for r in b.to_pylist()]
    assert sorted(found, key=repr) == sorted([rows[1], rows[4], rows[5], rows[6]], key=repr)


def test_state_partitions_follow_the_rows(spark, sf_dir, monkeypatch):
    from __spark_entry__ import queries
    from tidemart.plans import queries as plans
    cores = spark.sparkContext.defaultParallelism
    assert run.state_partitions(spark, 0) == cores == run.state_partitions(spark, cores * run.ROWS_PER_STATE)
    assert run.state_partitions(spark, 60 * run.ROWS_PER_STATE + 1) == 61
    asked, ask = [], plans.stream_session
    monkeypatch.setattr(run, "ROWS_PER_STATE", 500)
    monkeypatch.setattr(plans, "stream_session", lambda s, n=None, **more: asked.append(n) or ask(s, n, **more))
    found = queries()["stream_product_stats"](spark, sf_dir)
    assert found.count() and asked[0] > cores


def test_files_of_a_topic_have_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(run, "ROWS_PER_FILE", 10)
    rows = spark.range(100).coalesce(1).withColumn("ts", F.col("id"))
    for folders in run.in_order_of_time(spark, {"rows": rows}, {"rows": "ts"}, fresh_dir(spark, "bounded")):
        pass
    files = spark.read.parquet(folders["rows"]).groupBy(F.input_file_name()).count()
    assert files.agg(F.max("count"), F.sum("count")).first()[:] == (10, 100)


MEASURES = ", ".join([
    "sku_id long, ts long", *[f"{n} long" for n in stats._COUNTS], *[f"{n} decimal(16,2)" for n in stats._AMOUNTS],
    "id_kind string, id long"])


def test_closed_windows_are_those_of_the_stream(spark):
    """Rows out of order, one that is late, times missing and before 1970, a micro-batch without any time."""
    draw, path = random.Random(6), fresh_dir(spark, "measures")
    times = [[n * 900 - draw.choice([0, 0, 1_500]) for n in range(a, a + 60)] for a in (-20, 40, 100)]
    for some in (*times, [None, None], [500_000], [500_001, 3_000, 499_000]):
        rows = [
            (draw.choice([1, 2, None]), ts, *[draw.randrange(3) for _ in stats._COUNTS], *[draw.randrange(9) for _ in stats._AMOUNTS],
             draw.choice([None, stats.ORDERED, stats.PAID]), draw.choice([7, 8, None])) for ts in some]
        columns = spark.createDataFrame(rows, MEASURES.replace("decimal(16,2)", "long"))
        typed = columns.select(*[F.col(n).cast("decimal(16,2)") if n in stats._AMOUNTS else n for n in columns.columns])
        typed.coalesce(1).write.mode("append").parquet(path)
    own, base = stream_session(spark, 2), fresh_dir(spark, "closed")

    def stream():
        return own.readStream.schema(MEASURES).option("maxFilesPerTrigger", 1).parquet(path)

    def write(closed, batch_id):
        stats.product_sums(closed).write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    want = run.drained(spark, stats.product_sums(stream()), "sums")
    run.drain_to_batches(stream(), windows.closing("ts", stats.TEN_SECONDS, 2_000, f"{base}/kept", write), f"{base}/checkpoint")
    found = spark.read.schema(want.schema).parquet(f"{base}/out").drop("batch_id")
    assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect())) and want.count() > 20
    late = want.agg(F.max("edt")).first()[0]
    assert late < "1970-01-01 00:08:20"  # the window of the last rows is open


def test_stream_product_stats_keeps_open_windows_only(spark, sf_dir):
    from __spark_entry__ import queries
    folders = f"{shared_root(spark)}/product-stats-*"
    before = set(glob.glob(folders))
    assert queries()["stream_product_stats"](spark, sf_dir).count()
    (base,) = set(glob.glob(folders)) - before
    assert not glob.glob(f"{base}/checkpoint/state")
    read = spark.read.parquet(f"{base}/in/*").count()
    assert 0 < spark.read.parquet(f"{base}/kept/1/rows").count() < read / 20
