"""State with a life of its own, first-claim tables, tables made from rules, statistics kept by period."""

import random
import time

import pytest
from pyspark.sql import Row, functions as F

from tests.pages import PAGES, frame, page
from tidemart import bind
from tidemart.operators import changes, joins, logs, stats, visits
from tidemart.plans import flows
from tidemart.plans.layers import PERIOD
from tidemart.plans.periods import PeriodStatistics, periods_near
from tidemart.session import fresh_dir, stream_session
from tidemart.streaming import claims, renewed, run
from tidemart.streaming import rules as live_rules
from tidemart.streaming import visits as stream_visits

SENSOR = "id string, ts long, vc long"


def arrivals(seed=2, n=160):
    draw = random.Random(seed)
    sides = [], []
    for k in range(n):
        sides[draw.randrange(2)].append((draw.choice(["hot", "hot", "a", None]), 1_000 + k * 100 + draw.randrange(3) * 700, k))
    return sides


def file_streams(spark, sides, shape, parts=3):
    own, streams = stream_session(spark, 4), []
    for rows in sides:
        path, size = fresh_dir(spark, "side"), -(-len(rows) // parts)
        for at in range(0, len(rows), size):
            spark.createDataFrame(rows[at:at + size], shape).coalesce(1).write.mode("append").parquet(path)
        streams.append(own.readStream.schema(shape).parquet(path))
    return streams


def plain_join(sides, ttl, how, renew):
    """Changes by a loop over all rows ever seen, in order of time."""
    shown = {"inner": (0, 0), "left": (1, 0), "right": (0, 1), "full": (1, 1)}[how]
    seen, out = [], []
    for ts, side, vc, key in sorted((r[1], s, r[2], r[0]) for s in (0, 1) for r in sides[s] if r[0] is not None):
        partners = [x for x in seen if x["side"] != side and x["key"] == key and x["end"] >= ts]
        for x in partners:
            if shown[x["side"]] and not x["met"]:
                out.append((-1, ts, *((x["vc"], None) if x["side"] == 0 else (None, x["vc"]))))
            x["met"] = True
            if renew and shown[x["side"]]:
                x["end"] = ts + ttl
            out.append((1, ts, *((vc, x["vc"]) if side == 0 else (x["vc"], vc))))
        if shown[side] and not partners:
            out.append((1, ts, *((vc, None) if side == 0 else (None, vc))))
        seen.append({"side": side, "key": key, "end": ts + ttl, "vc": vc, "met": bool(partners)})
    for side in (0, 1):
        if shown[side]:
            out += [(1, r[1], *((r[2], None) if side == 0 else (None, r[2]))) for r in sides[side] if r[0] is None]
    return sorted(out, key=repr)


@pytest.mark.parametrize("how,renew,salts", [("left", True, 1), ("full", True, 1), ("right", False, 1), ("left", True, 3), ("inner", True, 3)])
def test_expiring_join_follows_arrivals(spark, how, renew, salts):
    sides = arrivals()
    left, right = file_streams(spark, sides, SENSOR, parts=1)
    found = run.drained(spark, renewed.expiring_join(
        left, right, {"id": "id"}, ("ts", "ts"), 500, how, renew, salts=salts), "expiring")
    got = sorted(map(tuple, found.select("change", "at", "l_vc", "r_vc").collect()), key=repr)
    assert got == plain_join(sides, 500, how, renew)


def test_folded_changes_equal_the_batch_join(spark):
    sides = arrivals(seed=5)
    frames = [spark.createDataFrame(rows, SENSOR) for rows in sides]
    left, right = file_streams(spark, sides, SENSOR, parts=1)
    changed = run.drained(spark, renewed.expiring_join(left, right, {"id": "id"}, ("ts", "ts"), 700, "full", False), "outer")
    batch = joins.ttl_join(*frames, {"id": "id"}, ("ts", "ts"), 700, "full")
    live = renewed.live_rows(changed)
    assert live.count() == batch.count() > 0 and live.exceptAll(batch).isEmpty()
    assert changed.where("change = -1").count() > 0


def test_salting_a_shown_copy_is_refused(spark):
    left, right = (spark.createDataFrame(rows, SENSOR) for rows in arrivals(n=10))
    with pytest.raises(ValueError):
        renewed.expiring_join(left, right, {"id": "id"}, ("ts", "ts"), 5, "full", salts=2)


def test_kept_rows_are_freed(spark):
    base, own = fresh_dir(spark, "freed"), stream_session(spark, 2)
    left_over = []
    for part in range(3):
        for side in ("a", "b"):
            rows = [(f"k{n}", 1_000 + part * 100_000 + n, n) for n in range(20)]
            spark.createDataFrame(rows[: 20 if part == 0 else 1], SENSOR).coalesce(1).write.mode("append").parquet(f"{base}/{side}")
        streams = [own.readStream.schema(SENSOR).parquet(f"{base}/{s}") for s in ("a", "b")]
        query = (
            renewed.expiring_join(*streams, {"id": "id"}, ("ts", "ts"), 500, "left").writeStream.format("parquet")
            .option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
        left_over.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert left_over[0] >= 40 and left_over[-1] < 10


def test_full_join_reads_each_side_once(spark, tmp_path):
    paths = []
    for n, rows in enumerate(arrivals(seed=9)):
        paths.append(str(tmp_path / f"s{n}"))
        spark.createDataFrame(rows, SENSOR).write.parquet(paths[-1])
    left, right = (spark.read.parquet(p) for p in paths)
    joined = joins.ttl_join(left, right, {"id": "id"}, ("ts", "ts"), 300, "full")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 and plan.count("Join") == 1
    pairs = [(a[2], b[2]) for a in left.collect() for b in right.collect()
             if a[0] is not None and a[0] == b[0] and abs(a[1] - b[1]) <= 300]
    want = pairs + [(a[2], None) for a in left.collect() if a[2] not in {p[0] for p in pairs}]
    want += [(None, b[2]) for b in right.collect() if b[2] not in {p[1] for p in pairs}]
    for width in (None, 70, 5_000):
        found = joins.interval_join(left, right, {"id": "id"}, ("ts", "ts"), -300, 300, "full", width=width)
        assert sorted(map(tuple, found.select("l_vc", "r_vc").collect()), key=repr) == sorted(want, key=repr)
    shifted = joins.interval_join(left, right, {"id": "id"}, ("ts", "ts"), 200, 900, "full")
    assert shifted.where("l_vc is not null").select("l_vc").distinct().count() == left.count()


def test_full_join_keeps_rows_without_key_or_time(spark):
    left = spark.createDataFrame([("a", None, 1), (None, 5, 2), ("a", 5, 3)], SENSOR)
    right = spark.createDataFrame([("a", None, 4), (None, 5, 5), ("a", 6, 6)], SENSOR)
    found = joins.ttl_join(left, right, {"id": "id"}, ("ts", "ts"), 3, "full").select("l_vc", "r_vc")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(3, 6), (1, None), (2, None), (None, 4), (None, 5)], key=repr)


DAY = 86_400_000


def test_late_first_visit_is_kept_and_state_expires(spark):
    """A visit two days behind the others is a first one; a mark that has expired lets a repeat through."""
    base, own = fresh_dir(spark, "visits"), stream_session(spark, 2, idle_batches=False)
    now = [page(1, "m", 10 * DAY), page(2, "m", 10 * DAY + 5), page(3, "n", 10 * DAY)]
    late = [page(4, "m", 8 * DAY), page(5, "m", 8 * DAY - 1, shown=2), page(6, "n", 10 * DAY + 9)]
    for keep, want in ((3_600_000, [1, 3, 4, 5]), (1, [1, 3, 4, 5, 6])):
        for n, rows in enumerate((now, late)):
            frame(spark, rows).coalesce(1).write.mode("append").parquet(f"{base}/in{keep}")
            stream = own.readStream.schema(PAGES).parquet(f"{base}/in{keep}")
            run.drain_to_files(stream_visits.unique_visits(stream, keep), f"{base}/out{keep}", f"{base}/checkpoint{keep}")
            time.sleep(0.1)
        out = spark.read.schema(PAGES).parquet(f"{base}/out{keep}")
        assert sorted(r.event_id for r in out.collect()) == want
        assert len(out.where("event_id = 5").first().displays) == 2


class _Map:
    """A map state that notes what is read."""

    def __init__(self):
        self.rows, self.read = {}, []

    def getValue(self, key):
        found = self.rows.get(key)
        self.read.append(len(found[0]) if found else 0)
        return found

    def keys(self):
        return iter(list(self.rows))

    def clear(self):
        self.rows.clear()

    def updateValue(self, key, value):
        self.rows[key] = value

    def removeKey(self, key):
        self.rows.pop(key, None)


class _Handle:
    def __init__(self):
        self.map, self.timers = _Map(), set()

    def getMapState(self, *_):
        return self.map

    def registerTimer(self, at):
        self.timers.add(at)


class _Now:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at

    def getExpiryTimeInMs(self):
        return self.at


@pytest.mark.parametrize("size", [50, 500])
def test_a_bounce_timer_reads_its_buckets_alone(size):
    finder, handle = stream_visits.BounceFinder(10_000), _Handle()
    finder.init(handle)
    rows = [Row(ts=n * 2_000, event_id=n, entry=n % 3 == 0, own=n % 3 == 0, value="v") for n in range(size)]
    assert list(finder.handleInputRows(("m", 0), iter(rows), None)) == []
    found = []
    while handle.timers:
        at = min(handle.timers)
        handle.timers.remove(at)
        handle.map.read = []
        found += [[r.event_id, r.bounce_kind] for r in finder.handleExpiredTimer(("m", 0), _Now(at), _Now(at))]
        assert sum(handle.map.read) <= 15
    assert not handle.map.rows
    last = 3 * ((size - 1) // 3)
    assert found == ([[last, "timeout"]] if last == size - 1 else [])


def claim_pages(seed):
    draw = random.Random(seed)
    return [page(n, draw.choice(["hot", "a", "b", "c", None]), 1_000 + draw.randrange(50), None, draw.choice(["0", "1", "1"]))
            for n in range(seed * 100, seed * 100 + 40)]


def test_first_claims_survive_repeats_and_merging(spark):
    name = f"claims_test_{random.randrange(1 << 40)}"
    claims.create_claims(spark, name, buckets=4)
    batches = [frame(spark, claim_pages(n + 1)) for n in range(5)]
    out = {}

    def write(batch, batch_id):
        out[batch_id] = sorted((r.event_id, r.common.is_new) for r in batch.collect())

    step = claims.repairing(name, write, merge_every=2)
    try:
        for n, batch in enumerate(batches):
            step(batch, n)
            first = out[n]
            step(batch, n)
            assert out[n] == first and len(first) == 40
        parts = sorted(r[0][5:11] for r in spark.sql(f"SHOW PARTITIONS {name}").collect())
        assert parts == ["batch-", "batch-", "upto-3"]
    finally:
        spark.sql(f"DROP TABLE {name}")
    seen, want = set(), {}
    for n, batch in enumerate(batches):
        rows = sorted(batch.collect(), key=lambda r: (r.ts, r.event_id))
        want[n] = []
        for r in rows:
            flag = r.common.is_new
            if flag == "1":
                flag = "0" if r.common.mid in seen else "1"
                seen.add(r.common.mid)
            want[n].append((r.event_id, flag))
        assert out[n] == sorted(want[n])


def test_first_claims_equal_the_batch_form(spark):
    pages = frame(spark, claim_pages(3))
    fresh = claims.new_claims(pages, spark.createDataFrame([], "visitor string"))
    mine = claims.flagged(pages, fresh).select("event_id", "common.is_new")
    batch = logs.repair_new_flag(pages).select("event_id", "common.is_new")
    assert mine.exceptAll(batch).isEmpty() and mine.count() == 40
    plan = claims.flagged(pages, fresh)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_rules_make_tables_while_a_stream_runs(spark, sf_dir):
    prefix, base = f"r{random.randrange(1 << 40)}_", fresh_dir(spark, "rules")
    shape = "sink_table string, source_table string, operate_type string, sink_type string, sink_columns string, sink_pk string, sink_extend string"
    known = []
    step = live_rules.dimension_batches(lambda own: own.createDataFrame(known, shape), base, prefix)
    made = changes.normalize(bind.user_changes(spark, sf_dir), keep=("offset",))
    step(made, 0)
    assert not spark.catalog.tableExists(f"{prefix}dim_u")
    known.append(("dim_u", "user_info", "insert", "hbase", "id,name", "id", "SALT_BUCKETS = 4, OWNER='it''s'"))
    known.append(("fact_u", "user_info", "insert", "kafka", "id", None, None))
    step(made, 1)
    step(made, 1)
    told = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {prefix}dim_u").collect()}
    assert told["dimension.key"] == "id" and told["dimension.option.SALT_BUCKETS"] == "4"
    assert not spark.catalog.tableExists(f"{prefix}fact_u")
    rows = live_rules.current_dimension(spark, f"{prefix}dim_u")
    inserts = changes.drop_deletes(made).where("type = 'insert'")
    assert rows.columns == ["id", "name"] and rows.count() == inserts.select(F.col("after")["id"]).distinct().count()
    known.append(("dim_u", "user_info", "update", "hbase", "id,name", None, None))
    renamed = made.where("type = 'update'").withColumn("after", F.map_concat(
        F.map_filter("after", lambda k, _: k != "name"), F.create_map(F.lit("name"), F.lit("new"))))
    step(renamed, 2)
    now = live_rules.current_dimension(spark, f"{prefix}dim_u")
    assert now.count() == rows.count() and now.where("name = 'new'").count() == renamed.count()


def test_periods_near():
    assert periods_near(["2024-01"], 0) == ["2024-01"]
    assert periods_near(["2024-03"], 1) == ["2024-02", "2024-03", "2024-04"]
    assert periods_near(["2024-03-01"], DAY) == ["2024-02-29", "2024-03-01", "2024-03-02"]


def test_only_touched_days_are_read_and_written(spark):
    rows = [page(n, f"m{n % 7}", n * DAY // 8, None if n % 2 else "home") for n in range(80)]
    late = [page(900 + n, "m1", 3 * DAY + n) for n in range(3)]
    pages = frame(spark, rows)
    kept = flows.visitor_by_period(spark, pages, fresh_dir(spark, "kept"), flows.Durations())
    kept.add(0, pages=pages)
    assert kept.add(1, pages=frame(spark, late)) == ["1970-01-03", "1970-01-04", "1970-01-05"]
    computed = kept.computed(["1970-01-04"])
    files = computed.inputFiles()
    assert files and all(any(f"{PERIOD}=1970-01-0{d}" in f for d in (3, 4, 5)) for f in files)
    before = {f for f in kept.table().inputFiles()}
    kept.add(1, pages=frame(spark, late))
    after = {f for f in kept.table().inputFiles()}
    assert {f.split(f"{PERIOD}=")[1][:10] for f in before ^ after} == {"1970-01-03", "1970-01-04", "1970-01-05"}
    whole = stats.visitor_stats(flows.visit_flow(frame(spark, rows + late), flows.Durations()).rows(), "10 seconds")
    mine = kept.table().drop(PERIOD)
    assert mine.count() == whole.count() and mine.exceptAll(whole.select(*mine.columns)).isEmpty()


def test_rows_without_a_time_are_refused(spark):
    rows = spark.createDataFrame([(None, 1)], "ts long, n long")
    kept = PeriodStatistics(spark, fresh_dir(spark, "kept"), {"r": rows.schema}, {"r": "ts"}, lambda read: read["r"])
    with pytest.raises(Exception, match="no time"):
        kept.add(0, r=rows)
