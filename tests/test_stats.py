from decimal import Decimal

from pyspark.sql import functions as F

from tests.pages import frame, page
from tidemart.functions import rates
from tidemart.functions.times import age_years, parse_time, seconds_time, time_text
from tidemart.operators import logs, orders, stats
from tidemart.plans import flows, reports


def test_times(spark):
    texts = ["2022-02-15 00:04:05", "2022-02-15", "2022-02-15 00:04:05.5", "15.02.2022 00:04:05", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r.x for r in rows.select(time_text(parse_time("t")).alias("x")).collect()]
    assert found == ["2022-02-15 00:04:05", None, "2022-02-15 00:04:05", None, None]
    cut = spark.range(1).select(time_text(seconds_time(F.lit(1_644_883_445_999))).alias("x"))
    assert cut.first().x == "2022-02-15 00:04:05"


def test_age_counts_years_of_365_days(spark):
    rows = spark.createDataFrame([("2000-01-01",), (None,)], "b string")
    found = [r.a for r in rows.select(age_years("b", F.lit("2003-12-31")).alias("a")).collect()]
    assert found == [4, None]


def rate_row(spark, uv, pv, sv, uj, dur):
    row = spark.createDataFrame([(uv, pv, sv, uj, dur)], "uv long, pv long, sv long, uj long, dur long")
    uv, pv, sv, uj, dur = [F.col(n) for n in row.columns]
    return tuple(row.select(
        rates.bounce_rate(uj, sv, uv), rates.seconds_per_visit(dur, sv, uv),
        rates.pages_per_visit(pv, sv, uv),
    ).first())


def test_rates_round_half_up_and_guard_zero(spark):
    assert rate_row(spark, 5, 1, 8, 1, 12_000) == (Decimal("12.50"), Decimal("1.50"), Decimal("0.13"))
    # 2250 ms per visit give 2.3 s; 449.5 ms are first rounded to 450 and then give 0.5 s.
    assert rate_row(spark, 1, 1, 1, 0, 2_250)[1] == Decimal("2.30")
    assert rate_row(spark, 1, 1, 2, 0, 899)[1] == Decimal("0.50")
    assert rate_row(spark, 1, 1, 3, 2, 0) == (Decimal("66.67"), Decimal("0.00"), Decimal("0.33"))
    assert rate_row(spark, 0, 9, 3, 1, 5) == (0, 0, 0) == rate_row(spark, 3, 9, 0, 1, 5)
    assert rate_row(spark, None, None, None, None, None) == (0, 0, 0)


def visitor(spark, rows, **options):
    flow = flows.visit_flow(logs.repair_new_flag(frame(spark, rows)))
    return stats.visitor_stats(flow.rows(**options), "10 seconds")


def test_visitor_stats_and_both_session_rules(spark):
    rows = [page(1, "m", 10_000), page(2, "m", 11_000, "home", during=None), page(3, "m", 30_000)]
    first = visitor(spark, rows).where("stt = '1970-01-01 00:00:10'").first()
    assert (first.edt, first.uv_ct, first.pv_ct, first.sv_ct, first.uj_ct, first.dur_sum, first.ts) == (
        "1970-01-01 00:00:20", 1, 2, 1, 0, 5, 10_000)
    second = visitor(spark, rows).where("stt = '1970-01-01 00:00:30'").first()
    assert (second.uv_ct, second.uj_ct) == (0, 1)
    assert visitor(spark, rows, literal=True).agg(F.sum("sv_ct")).first()[0] == 1


EMPTY = {
    "favors": "sku_id long, create_time string", "carts": "sku_id long, create_time string",
    "orders": "order_id long, sku_id long, sku_num long, split_total_amount decimal(16,2), create_time string",
    "payments": "order_id long, sku_id long, split_total_amount decimal(16,2), payment_create_time string",
    "refunds": "order_id long, sku_id long, refund_amount decimal(16,2), create_time string",
    "comments": "sku_id long, appraise string, create_time string",
}


def product_rows(spark, pages=(), **inputs):
    parts = {n: spark.createDataFrame(inputs.get(n, []), shape) for n, shape in EMPTY.items()}
    return stats.product_rows(frame(spark, list(pages)), **parts)


def test_product_stats_count_ids_once(spark):
    at, amount = "1970-01-01 00:00:02", Decimal("1.50")
    rows = product_rows(
        spark,
        pages=[page(1, "m", 1_000, item="1", page_id="good_detail", shown=3),
               page(2, "m", 1_000, item="1", page_id="home")],
        favors=[(1, at)], carts=[(1, at), (1, at)],
        orders=[(7, 1, 2, amount, at), (7, 1, 3, amount, at), (8, 1, 1, None, at), (9, 1, 1, amount, "1970-01-01 00:00:10")],
        payments=[(7, 1, amount, at), (7, 1, amount, at)],
        refunds=[(7, 1, None, at), (None, 1, amount, at)],
        comments=[(1, "1201", at), (1, "1203", at), (1, None, at)],
    )
    found = {(r.stt, r.sku_id): r for r in stats.product_sums(rows, "10 seconds").collect()}
    row = found["1970-01-01 00:00:00", 1]
    assert (row.click_ct, row.display_ct, row.favor_ct, row.cart_ct) == (1, 1, 1, 2)
    assert (row.order_ct, row.order_sku_num, row.order_amount) == (2, 6, Decimal("3.00"))
    assert (row.paid_order_ct, row.payment_amount) == (1, Decimal("3.00"))
    assert (row.refund_order_ct, row.refund_amount) == (1, Decimal("1.50"))
    assert (row.comment_ct, row.good_comment_ct, row.ts) == (3, 1, 1_000)
    assert found["1970-01-01 00:00:10", 1].order_ct == 1
    assert found["1970-01-01 00:00:00", 0].display_ct == 1


def test_first_non_null(spark):
    shape = "id long, a string, b string"
    left = spark.createDataFrame([(1, None, None), (2, "x", "y")], shape)
    right = spark.createDataFrame([(1, "p", "q"), (2, "r", "s")], shape)
    out = orders.first_non_null(left, right, ["id"], own_only=("b",))
    assert {tuple(r) for r in out.collect()} == {(1, "p", None), (2, "x", "y")}


VISITORS = "stt string, is_new string, uv_ct long, pv_ct long, sv_ct long, uj_ct long, dur_sum long"


def test_hours_are_filled(spark):
    rows = spark.createDataFrame(
        [("2024-01-15 03:10:00", "1", 2, 5, 1, 0, 9), ("2024-01-15 03:20:00", "0", 1, 1, 1, 0, 9),
         ("2024-01-16 00:00:00", "1", 9, 9, 9, 9, 9)], VISITORS)
    found = [tuple(r) for r in reports.hours_filled(rows, "20240115").collect()]
    assert len(found) == 24 and found[3] == ("03", 3, 6, 2)
    assert all(row[1:] == (0, 0, 0) for n, row in enumerate(found) if n != 3)


def test_missing_side_of_the_rates_is_zero(spark):
    rows = spark.createDataFrame([("2024-01-15 03:10:00", "1", 2, 5, 4, 1, 9_000)], VISITORS)
    found = {r.type: (r.new, r.old) for r in reports.visitor_rates(rows, "20240115").collect()}
    assert list(found) == reports.RATE_ROWS
    assert found["bounce_rate"] == (Decimal("25.00"), 0) and found["pages"] == (5, 0)
    assert {r.old for r in reports.visitor_rates(rows, "20240101").collect()} == {0}


def test_reports_default_to_today(spark):
    today = spark.sql("select date_format(current_timestamp(), 'yyyy-MM-dd HH:mm:ss') t").first().t
    shape = "stt string, order_amount decimal(38,2)"
    rows = spark.createDataFrame([(today, Decimal("3.00")), ("2001-01-01 00:00:00", Decimal("9.00"))], shape)
    assert reports.gross_sales(rows).first()[0] == Decimal("3.00")
    assert reports.gross_sales(rows, "19990101").first()[0] == 0


def test_keyword_weights_ignore_case_and_rank_by_count(spark):
    rows = spark.createDataFrame(
        [("2024-01-15 00:00:00", "a", 3, "search"), ("2024-01-15 00:00:00", "b", 9, "CLICK"),
         ("2024-01-15 00:00:00", "b", 1, "OTHER"), ("2024-01-15 00:00:00", "c", 1, "ORDER")],
        "stt string, keyword string, ct long, source string")
    found = [tuple(r) for r in reports.keyword_scores(rows, "20240115", limit=2).collect()]
    assert found == [("b", 9), ("a", 30)]


def test_period_filter_reaches_the_scan_of_stored_stats(spark, tmp_path):
    path = str(tmp_path / "stats")
    spark.createDataFrame([("2024-01-15 00:00:00", Decimal("1.00"))],
                          "stt string, order_amount decimal(38,2)").write.parquet(path)
    plan = reports.gross_sales(spark.read.parquet(path), "20240115")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(stt,2024-01-15" in text


def test_reports_read_their_partitions_alone(spark, sf_dir):
    flows.build_statistics(spark, sf_dir)
    cases = {
        "product": [reports.gross_sales, reports.by_trademark, reports.by_category3, reports.by_spu],
        "province": [reports.by_province], "keyword": [reports.keyword_scores],
        "visitor": [reports.by_new_flag, reports.visitor_rates, reports.by_hour, reports.hours_filled],
    }
    for name, functions in cases.items():
        table = flows.statistics(spark, sf_dir, name)
        for report in functions:
            for day in ("19970310", None):
                plan = report(table, day)._jdf.queryExecution().executedPlan().toString()
                scan = next(line for line in plan.split("\n") if "FileScan" in line and "dt#" in line)
                filters = scan.split("PartitionFilters: [")[1].split("]")[0]
                assert "dt#" in filters and ">=" in filters and "<=" in filters, (report.__name__, day)
    one = flows.statistics(spark, sf_dir, "product").where("dt = '1997-03'")
    assert all("dt=1997-03" in path for path in one.select("stt", F.input_file_name().alias("f")).select("f").toPandas().f)


def test_layers_follow_their_files_and_split_a_busy_period(spark, tmp_path):
    from tidemart.plans.layers import layer
    source, when = str(tmp_path / "t.parquet"), "2024-01-15 00:00:00"

    def write(n):
        spark.range(n).select(F.lit(when).alias("stt"), "id").write.mode("overwrite").parquet(source)

    def asked():
        return layer(spark, str(tmp_path), "busy", lambda: spark.read.parquet(source), 10)

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write(4_000)
        first = asked()
        assert first.count() == 4_000 and first.columns == ["stt", "id", "dt"]
        assert first.select(F.input_file_name()).distinct().count() > 1
        assert asked().inputFiles() == first.inputFiles()
        write(7)
        assert asked().count() == 7
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def measures(spark, amounts):
    shape = "sku_id long, ts long, id_kind string, id long, order_amount decimal(16,2)"
    rows = spark.createDataFrame([(1, 5, "order", n, a) for n, a in enumerate(amounts)], shape)
    others = {n: F.lit(0).cast("long") for n in stats._COUNTS} | {
        n: F.lit(0).cast("decimal(16,2)") for n in ("payment_amount", "refund_amount")}
    return rows.withColumns(others)


def test_amounts_are_summed_as_whole_numbers_and_stay_exact(spark):
    most = Decimal("99999999999999.99")
    for amounts in ([most] * 3000, [-most] * 3000, [Decimal("-0.01"), Decimal("0.03")], [most, -most, None], [None]):
        found = stats.product_sums(measures(spark, amounts))
        known = [a for a in amounts if a is not None]
        assert found.first().order_amount == (sum(known) if known else None)
        assert "decimal" not in "".join(
            line for line in plan_of(found).split("\n") if "HashAggregate" in line and "partial_sum" in line)


def test_the_join_of_orders_moves_only_what_the_measures_read(spark, sf_dir):
    kept = flows.product_inputs(spark, sf_dir)["orders"]
    filled = kept.agg(*[F.count(n).alias(n) for n in kept.columns]).first().asDict()
    assert {n for n, c in filled.items() if c} == {"order_id", "sku_id", "sku_num", "split_total_amount", "create_time"}


def test_kept_statistics_join_the_orders_once(spark, sf_dir, monkeypatch):
    from __spark_entry__ import queries
    made = []
    monkeypatch.setattr(flows, "product_measures", lambda *a, ask=flows.product_measures: made.append(1) or ask(*a))
    assert queries()["stats_one_day_more"](spark, sf_dir).count() and len(made) == 1


def test_periods_are_dealt_without_computing_the_rows_for_a_sample(spark):
    from tidemart.plans.layers import dealt_by_period
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.range(1000).select(F.lit("2024-01").alias("dt"), F.lit("2024-01-15 00:00:00").alias("stt"), "id")
    dealt = dealt_by_period(rows.mapInPandas(count, rows.schema))
    assert dealt.toPandas().id.nunique() == 1000 and seen.value == 1000 and dealt.columns == rows.columns


def test_good_and_dirty_times_are_all_rows(spark, sf_dir):
    from tidemart import bind
    for rows in (bind.favor_info(spark, sf_dir), bind.cart_info(spark, sf_dir)):
        parsed = orders.parse_created(rows)
        good, bad = orders.good_times(parsed).count(), orders.bad_times(parsed).count()
        assert good + bad == rows.count() and good and bad
    measures = spark.createDataFrame([(1, 5), (None, 5), (1, None)], "sku_id long, ts long")
    assert (stats.complete(measures).count(), stats.incomplete(measures).count()) == (1, 2)


def test_measures_and_dirty_rows_are_all_of_the_seven_inputs(spark):
    at, bad, amount = "1970-01-01 00:00:02", "on 1970", Decimal("1.50")
    touched = [(i, t) for i in ("1", None, "x9") for t in (at, bad)]
    tables = {
        "favors": touched, "carts": touched, "orders": [(7, i, 1, amount, t) for i, t in touched],
        "payments": [(7, i, amount, t) for i, t in touched], "refunds": [(7, i, amount, t) for i, t in touched],
        "comments": [(i, "1201", t) for i, t in touched],
    }
    inputs = {n: spark.createDataFrame(rows, EMPTY[n].replace("sku_id long", "sku_id string")) for n, rows in tables.items()}
    inputs["pages"] = frame(spark, [
        page(n, "m", t, item=i, page_id=p, shown=2)
        for n, (i, t, p) in enumerate((i, t, p) for i in ("1", None, "x9") for t in (1_000, None) for p in ("good_detail", "home"))
    ] + [page(20, "m", None, item="5"), page(21, "m", 1_000, item="5")])
    clean = stats.complete(stats.product_rows(**inputs))
    dirty = [tuple(r) for r in stats.product_dirty(**inputs).collect()]
    assert clean.columns[:2] == ["sku_id", "ts"] and clean.columns[-1] == "id"
    left = [(i, t) for i, t in touched if (i, t) != ("1", at)]
    for name in tables:
        assert sorted(map(str, (d[1:] for d in dirty if d[0] == name[:-1]))) == sorted(map(str, left)), name
    # Six pages with an article click it, twelve display two: one click and twelve displays are whole.
    seen = {kind: [d[1:] for d in dirty if d[0] == kind] for kind in ("click", "display", "page")}
    assert sorted(map(str, seen["click"])) == sorted(map(str, [
        ("1", None), (None, None), (None, "1000"), ("x9", None), ("x9", "1000")]))
    assert len(seen["display"]) == 12 and all(time is None for _, time in seen["display"])
    assert seen["page"] == [("5", None)]
    assert clean.count() + len(dirty) == 6 * len(touched) + 6 + 24 + 1
