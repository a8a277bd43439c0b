import json

from pyspark.sql import functions as F

from tests.pages import frame, page
from tidemart.operators import logs

GOOD = {"common": {"mid": "m", "is_new": "1"}, "page": {"page_id": "home"}, "ts": 5}


def lines(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "event_id long, value string")


def test_bad_lines_are_told_apart(spark):
    texts = [
        json.dumps(GOOD), json.dumps(GOOD)[:-4], "", None, "[1, 2]",
        json.dumps({**GOOD, "common": None}), json.dumps({**GOOD, "page": None}),
        json.dumps({"common": {"mid": "m"}, "start": {"entry": "icon"}, "ts": 1}),
        json.dumps({**GOOD, "ts": "no number"}),
    ]
    parsed = logs.parse_log(lines(spark, *texts))
    reasons = {row.event_id: row.reason for row in parsed.collect()}
    assert reasons[0] is None and reasons[7] is None
    assert {n: reasons[n] for n in (1, 3, 8)} == dict.fromkeys((1, 3, 8), "not_json")
    assert reasons[2] is not None and reasons[4] is not None
    assert (reasons[5], reasons[6]) == ("no_common", "no_page")
    dirty = {row.event_id: row.value for row in logs.dirty_lines(parsed).collect()}
    assert dirty[1] == texts[1] and set(dirty) == {1, 2, 3, 4, 5, 6, 8}
    assert {r.event_id for r in logs.clean_logs(parsed).collect()} == {0, 7}


def test_text_is_parsed_once(spark):
    parsed = logs.clean_logs(logs.parse_log(lines(spark, json.dumps(GOOD))))
    plan = parsed.select("common.mid", "ts")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def repaired(spark, *flags):
    rows = [page(n, "m", n, is_new=flag) for n, flag in enumerate(flags)]
    fixed = logs.repair_new_flag(frame(spark, rows))
    return [row.is_new for row in fixed.orderBy("event_id").select("common.is_new").collect()]


def test_new_flag_runs(spark):
    assert repaired(spark, "1", "1") == ["1", "0"]
    assert repaired(spark, "0", "1") == ["0", "1"]
    assert repaired(spark, "1", "0", "1") == ["1", "0", "0"]
    assert repaired(spark, None, "1", None, "1") == [None, "1", None, "0"]


def test_new_flag_order_and_ties(spark):
    rows = [page(9, "m", 10, is_new="1"), page(3, "m", 10, is_new="1"),
            page(1, "m", 20, is_new="1"), page(5, None, 1, is_new="1"), page(6, None, 2, is_new="1")]
    fixed = logs.repair_new_flag(frame(spark, rows))
    assert {r.event_id for r in fixed.where("common.is_new = '1'").collect()} == {3, 5}
    assert fixed.count() == 5


def test_split_and_fan_out_agree(spark):
    start = {"common": {"mid": "m"}, "start": {"entry": "icon"}, "ts": 1}
    shown = {**GOOD, "displays": [{"item": "1", "item_type": "sku_id"},
                                  {"item": "2", "item_type": "promotion"}]}
    texts = [json.dumps(GOOD), json.dumps(shown), json.dumps({**GOOD, "displays": []}),
             json.dumps(start), "{"]
    parsed = logs.parse_log(lines(spark, *texts))
    topics = {name: name for name in ("page", "start", "display", "dirty")}
    sent = logs.fan_out(parsed, topics)
    counts = {r.topic: r["count"] for r in sent.groupBy("topic").count().collect()}
    assert counts == {"page": 3, "start": 1, "display": 2, "dirty": 1}
    clean = logs.clean_logs(parsed)
    assert logs.page_logs(clean).count() == 3 and logs.start_logs(clean).count() == 1
    assert logs.display_logs(logs.page_logs(clean)).count() == 2
    value = sent.where("topic = 'start'").first().value
    assert json.loads(value)["start"] == {"entry": "icon"}
    display = json.loads(sent.where("topic = 'display'").orderBy("value").first().value)
    assert display == {"item": "1", "item_type": "sku_id", "page_id": "home", "ts": 5}


def test_json_rows_round_trip(spark):
    rows = logs.to_json_rows(frame(spark, [page(1, "m", 7, shown=2)]))
    back = json.loads(rows.first().value)
    assert back["common"]["mid"] == "m" and len(back["displays"]) == 2 and back["ts"] == 7
    assert rows.where(F.col("value").contains("last_page_id")).count() == 0


def test_a_claim_without_a_time_comes_last(spark):
    rows = [page(1, "m", None, None, "1"), page(2, "m", 5, None, "1"), page(3, "m", 5, None, "1"), page(4, "n", None, None, "1"),
            page(5, "m", 1, None, "0"), page(6, None, 9, None, "1")]
    fixed = logs.repair_new_flag(frame(spark, rows))
    assert {r.event_id: r.common.is_new for r in fixed.collect()} == {1: "0", 2: "1", 3: "0", 4: "1", 5: "0", 6: "1"}


def test_records_without_a_time_are_dirty(spark):
    line = '{"common":{"mid":"m","is_new":"1"},"page":{"page_id":"p"}}'
    parsed = logs.parse_log(spark.createDataFrame([(line,), (line[:-1] + ',"ts":5}',)], "value string"))
    assert [r.reason for r in parsed.orderBy("ts").collect()] == ["no_ts", None]
