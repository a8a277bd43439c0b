import pytest

from tidemart.operators.changes import dimension_schema
from tidemart.session import fresh_dir, shared_root
from tidemart.sinks import tables, topics
from tidemart.sources import changes as change_sources
from tidemart.sources import tables as table_sources
from tidemart.sources import topics as topic_sources
from tidemart.streaming import run

SHAPE = dimension_schema("id,name")


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, name string")


def current(spark, path, upto=None):
    return {tuple(r) for r in tables.read_current(spark, path, SHAPE, "id", upto).collect()}


def test_dimension_store(spark):
    path = fresh_dir(spark, "store")
    assert current(spark, path) == set()
    write = tables.dimension_writer(path, "id", SHAPE, lambda b: b, compact_every=2)
    write(batch(spark, ("1", "a"), ("2", "b")), 0)
    assert current(spark, path) == {("1", "a"), ("2", "b")}
    for _ in range(2):
        write(batch(spark, ("2", "c")), 1)
    assert tables._parts(spark, path, tables.BASE) == [1]
    write(batch(spark, ("2", "d"), ("3", None)), 2)
    expected = {("1", "a"), ("2", "d"), ("3", None)}
    assert current(spark, path) == expected
    write(batch(spark, ("2", "d"), ("3", None)), 2)
    assert current(spark, path) == expected
    assert current(spark, path, upto=1) == {("1", "a"), ("2", "c")}
    for number in range(3, 8):
        write(batch(spark, ("9", str(number))), number)
    assert current(spark, path) == expected | {("9", "7")}
    assert tables._parts(spark, path, tables.BASE) == [5, 7]


def test_dimension_store_takes_rows_away(spark):
    path = fresh_dir(spark, "gone")
    write = tables.dimension_writer(path, "id", SHAPE, lambda b: b, compact_every=3)
    shape = "id string, name string, _deleted boolean"
    for number, row in enumerate([("1", "a", False), ("1", "a", True), ("2", "b", None)]):
        write(spark.createDataFrame([row], shape), number)
        assert current(spark, path) == [{("1", "a")}, set(), {("2", "b")}][number]
    write(spark.createDataFrame([("1", "z", False)], shape), 3)
    assert current(spark, path) == {("1", "z"), ("2", "b")}


def test_stats_batches_are_replaced_when_repeated(spark):
    path = fresh_dir(spark, "stats")
    write = tables.stats_writer(path, ["name"], transient=["id"])
    for number, rows in [(0, [("1", "a")]), (1, [("2", "b")]), (1, [("2", "b")])]:
        write(batch(spark, *rows), number)
    found = spark.read.parquet(path)
    assert sorted(r.name for r in found.collect()) == ["a", "b"] and "id" not in found.columns


def test_dimension_table_is_created_once(spark):
    path = fresh_dir(spark, "table")
    for _ in range(2):
        tables.create_dimension(spark, "dim_test_table", SHAPE, path)
    assert spark.table("dim_test_table").columns == ["id", "name"]
    spark.sql("drop table dim_test_table")


def test_snapshot_then_tail(spark):
    path = fresh_dir(spark, "capture")
    spark.createDataFrame(
        [("t.shop.brand", 0, '{"op":"u"}'), ("t.shop.other", 1, "{}")],
        change_sources.CHANGE_COLUMNS).write.parquet(path)
    tail = change_sources.read_changes(
        spark, topics="t[.]shop[.]brand", format="parquet", path=path, stream=False)
    first = change_sources.snapshot_envelopes(batch(spark, ("1", "a")), "t.shop.brand")
    rows = first.unionByName(tail).orderBy("offset").collect()
    assert [(r.offset, r.value) for r in rows] == [
        (-1, '{"after":{"id":"1","name":"a"},"source":{"db":"shop","table":"brand"},"op":"r"}'),
        (0, '{"op":"u"}')]


def test_lines_with_gaps(spark):
    lines = spark.createDataFrame([("a,1,2.5",), ("a,x",), ("",)], "value string")
    found = {tuple(r) for r in topic_sources.split_lines(lines).collect()}
    assert found == {("a", 1, 2.5), ("a", None, None), ("", None, None)}


def test_daily_log_files(spark):
    path = fresh_dir(spark, "daily")
    spark.createDataFrame([("x",)], "value string").write.text(f"{path}/app.2024-01-02")
    rows = topic_sources.log_files(spark, f"{path}/*", stream=False).collect()
    assert [tuple(r) for r in rows] == [("x", "2024-01-02")]


def test_point_read_is_pushed_down(spark):
    path = run.stored(spark, batch(spark, ("1", "a"), ("2", "b")), "dim")
    found = table_sources.by_key(table_sources.read_dimension(spark, path), "2")
    assert [r.name for r in found.collect()] == ["b"]
    assert "EqualTo(id,2)" in found._jdf.queryExecution().executedPlan().toString()


def test_fixed_topic_and_console(spark):
    path = run.stored(spark, spark.createDataFrame([("x",)], "value string"), "lines", "text")
    base = fresh_dir(spark, "topic")
    stream = topic_sources.read_topic(spark, "t", format="text", path=path)
    topics.write_topic(stream, f"{base}/c", topic="t", format="text", path=f"{base}/o",
                       available_now=True).awaitTermination()
    assert [r.value for r in spark.read.text(f"{base}/o").collect()] == ["x"]
    shown = topics.print_rows(stream, f"{base}/p", "tag")
    shown.processAllAvailable()
    shown.stop()


class _Cluster:
    """A session on a cluster, as far as the shared folder is concerned."""

    def __init__(self, named):
        self.conf = self
        self.sparkContext = self
        self.master = "yarn"
        self._named = named

    def get(self, key, default=None):
        return self._named


def test_a_cluster_must_name_its_folder():
    assert shared_root(_Cluster("/shared/x/")) == "/shared/x"
    with pytest.raises(ValueError):
        shared_root(_Cluster(None))


def test_shown_rows_are_files_that_the_tasks_write(spark, tmp_path):
    spark.range(50).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    shown = topics.print_rows(
        stream, str(tmp_path / "checkpoint"), "shown", format="parquet", available_now=True, path=str(tmp_path / "out"))
    shown.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(50))
