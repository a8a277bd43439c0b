import json

from pyspark.sql import functions as F

from tidemart import bind, schemas
from tidemart.operators import changes


def envelope(offset, op, before=None, after=None, topic="t.shop.user"):
    return (topic, offset, json.dumps({"before": before, "after": after, "op": op}))


def normal(spark, *rows, **options):
    raw = spark.createDataFrame(list(rows), "topic string, offset long, value string")
    return changes.normalize(raw, keep=("offset",), **options)


def test_normal_form(spark):
    out = normal(
        spark, envelope(1, "c", after={"id": 1, "name": None}), envelope(2, "r", after={"id": 2}),
        envelope(3, "u", {"id": 1}, {"id": 1}), envelope(4, "D", {"id": 1}), envelope(5, None),
        ("nodots", 6, "{}"),
    ).orderBy("offset").collect()
    assert [r.type for r in out] == ["insert", "insert", "update", "delete", None, None]
    assert (out[0].database, out[0].tableName) == ("shop", "user")
    assert out[0].before == {} and out[0].after == {"id": "1", "name": None}
    assert out[3].after == {} and out[3].before == {"id": "1"}
    assert out[5].database is None


def test_snapshot_rows_can_stay_reads(spark):
    out = normal(spark, envelope(1, "r", after={}), envelope(2, "c", after={}),
                 map_read_to_insert=False)
    assert [r.type for r in out.orderBy("offset").collect()] == ["read", "insert"]


def test_deletes_are_dropped_and_unknown_kinds_kept(spark):
    kept = changes.drop_deletes(normal(spark, envelope(1, "d", {}), envelope(2, None)))
    assert [r.offset for r in kept.collect()] == [2]


def rules(spark, *rows):
    filled = [(*row, None, None) for row in rows]
    return spark.createDataFrame(filled, schemas.RULE)


def test_routing(spark):
    table = rules(
        spark, ("user", "insert", "hbase", "dim_user", "id,name"),
        ("order", "insert", "kafka", "dwd_order", "id, user"),
        ("logs", "insert", "clickhouse", "copy", "id"),
    )
    rows = [
        envelope(1, "c", after={"id": 1, "name": "a", "age": 3}),
        envelope(2, "u", {"id": 1}, {"id": 1}),
        envelope(3, "c", after={"id": 5, "user": 2, " user": 9}, topic="t.shop.order"),
        envelope(4, "c", after={"id": 5}, topic="t.shop.logs"),
        envelope(5, "c", after={"id": 5}, topic="t.shop.other"),
    ]
    routed = changes.route(normal(spark, *rows), table)
    dims, facts = changes.routed_dimensions(routed).collect(), changes.routed_facts(routed).collect()
    assert [(r.offset, r.sinkTable, r.after) for r in dims] == [(1, "dim_user", {"id": "1", "name": "a"})]
    # Names are not trimmed, so ' user' is another column than 'user'.
    assert [(r.offset, r.after) for r in facts] == [(3, {"id": "5", " user": "9"})]


def rule_event(offset, source, operation, sink):
    after = {"source_table": source, "operate_type": operation, "sink_type": "kafka", "sink_table": sink}
    return envelope(offset, "c", after=after, topic="t.conf.table_process")


def test_last_rule_wins_and_deletes_name_none(spark):
    out = changes.rules_from_changes(normal(
        spark, rule_event(1, "a", "insert", "x"), rule_event(5, "a", "insert", "y"),
        rule_event(3, "a", "update", "z"), envelope(9, "d", {"source_table": "a"}),
    ))
    assert {(r.source_table, r.operate_type, r.sink_table) for r in out.collect()} == {
        ("a", "insert", "y"), ("a", "update", "z")}


def test_current_table_follows_deletes_and_rebirth(spark):
    out = changes.current_table(normal(
        spark, envelope(1, "c", after={"id": 1, "v": "a"}), envelope(2, "d", {"id": 1}),
        envelope(3, "c", after={"id": 2, "v": "b"}), envelope(4, "u", {"id": 2}, {"id": 2, "v": "c"}),
        envelope(5, "c", after={"id": 3, "v": "d"}), envelope(6, "d", {"id": 3}),
        envelope(7, "c", after={"id": 3, "v": "e"}),
    ))
    assert {(r.after["id"], r.after["v"]) for r in out.collect()} == {("2", "c"), ("3", "e")}


def test_dimension_shape_and_rows(spark):
    shape = changes.dimension_schema("id,name,sex")
    assert [f.nullable for f in shape.fields] == [False, True, True]
    assert [f.nullable for f in changes.dimension_schema("code,name", "code").fields] == [False, True]
    table = rules(spark, ("user", "insert", "hbase", "dim_user", "id,name"))
    routed = changes.route(
        normal(spark, envelope(1, "c", after={"id": 1, "name": "old"}),
               envelope(2, "c", after={"id": 1, "name": None})), table)
    rows = changes.dimension_rows(routed, "dim_user", "id,name").collect()
    assert [tuple(r) for r in rows] == [("1", None)]


def test_envelope_is_parsed_once(spark):
    table = rules(spark, ("user", "insert", "hbase", "dim_user", "id,name"))
    plan = changes.route(normal(spark, envelope(1, "c", after={"id": 1})), table)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json(") == 1


def test_upsert(spark):
    old = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    new = spark.createDataFrame([("2", "c"), ("3", "d")], "id string, v string")
    assert {tuple(r) for r in changes.upsert(old, new, "id").collect()} == {
        ("1", "a"), ("2", "c"), ("3", "d")}


def test_latest_per_key_shuffles_one_row_per_key(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id").repartition(5)
    latest = changes.latest_per_key(df, ["k"], "id")
    assert {r.id for r in latest.collect()} == {97, 98, 99}
    assert "WindowGroupLimit" in latest._jdf.queryExecution().executedPlan().toString()


def test_rules_go_to_the_changes_and_not_the_other_way(spark, tmp_path):
    """Changes of a known small size and rules of unknown size: neither moves the changes."""
    rows = [("user_info", "insert", {"id": "1", "name": "a"}), ("none", "insert", {"id": "2"})]
    shape = "tableName string, type string, after map<string,string>"
    spark.createDataFrame(rows, shape).write.parquet(str(tmp_path / "changes"))
    found = changes.route(spark.read.schema(shape).parquet(str(tmp_path / "changes")), bind.rules(spark))
    plan = found._jdf.queryExecution().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan and "SortMergeJoin" not in plan
    assert [(r.sinkTable, r.after) for r in found.collect()] == [("dim_user_info", {"id": "1", "name": "a"})]
