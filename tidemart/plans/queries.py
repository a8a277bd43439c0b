"""Every operator as a query over the benchmark tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import LongType, StructType

from tidemart import bind, schemas
from tidemart.functions.names import camel_columns
from tidemart.functions.text import keyword_rows, register_keyword_function, word_list
from tidemart.functions.times import millis_date, millis_time, seconds_time, time_text
from tidemart.operators import changes, joins, logs, orders, stats, visits
from tidemart.plans import flows, reports
from tidemart.plans.layers import PERIOD
from tidemart.plans.periods import PeriodStatistics
from tidemart.sinks import tables as table_sinks
from tidemart.sinks import topics as topic_sinks
from tidemart.session import fresh_dir, stream_session
from tidemart.sources import changes as change_sources
from tidemart.sources import tables as table_sources
from tidemart.sources import topics as topic_sources
from tidemart.streaming import joins as stream_joins
from tidemart.streaming import claims, renewed, run, windows
from tidemart.streaming import visits as stream_visits
from tidemart.streaming.dims import fresh_lookup
from tidemart.streaming.rules import current_dimension, dimension_batches, routed_batches

# Only the fields the keyword job reads, the page as a map.
_PAGE_MAP = schemas.struct_of(page=schemas.TEXT_MAP, ts=LongType())

Query = Callable[[SparkSession, str], DataFrame]

_registry: dict[str, Query] = {}

DURATIONS = flows.SPARSE
SENSOR_BOUND = flows.HOUR
RENEWED_TTL = 24 * flows.HOUR
PRODUCT_DELAY = 2000
VISIT_DAY = "20240115"
SALES_FROM, SALES_TO = "19970101", "19981231"
SALES_DATE = "1998-02-08"
TOPICS = {
    "page": "dwd_page_log", "start": "dwd_start_log",
    "display": "dwd_display_log", "dirty": "dirty_log",
}


def query(function: Query) -> Query:
    _registry[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_registry)


def flat(pages: DataFrame, *extra: str) -> DataFrame:
    return pages.select(
        "event_id", "common.*",
        *[F.col(f"page.{n}").alias(n) for n in schemas.PAGE.fieldNames()],
        F.size("displays").cast("long").alias("n_displays"), "ts", *extra,
    )


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    return logs.parse_log(bind.raw_log(spark, d))


def _normal(spark: SparkSession, d: str) -> DataFrame:
    return changes.normalize(bind.raw_changes(spark, d), keep=("offset",))


def _routed(spark: SparkSession, d: str) -> DataFrame:
    kept = changes.drop_deletes(_normal(spark, d))
    return changes.route(kept, bind.rules(spark))


def _maps_as_text(df: DataFrame, *names: str) -> DataFrame:
    for name in names:
        df = df.withColumn(name, F.to_json(name))
    return df


# Sources


@query
def src_topic(spark, d):
    messages = logs.to_json_rows(bind.page_log(spark, d))
    path = run.stored(spark, messages, "page-topic", "text")
    stream = topic_sources.read_topic(spark, "dwd_page_log", format="text", path=path)
    shape = StructType([*schemas.PAGE_LOG.fields]).add("event_id", "long")
    return flat(run.drained(spark, topic_sources.parsed(stream, shape), "src-topic"))


@query
def src_sql_table(spark, d):
    messages = logs.to_json_rows(bind.page_log(spark, d))
    path = run.stored(spark, messages, "page-topic", "text")
    own = stream_session(spark)
    stream = topic_sources.read_topic(own, "dwd_page_log", format="text", path=path)
    shape = _PAGE_MAP
    topic_sources.topic_table(stream, "page_log", shape, seconds_time("ts"))
    found = own.sql(
        "select page['item'] key_word, date_format(rt, 'yyyy-MM-dd HH:mm:ss') rt from page_log "
        "where page['last_page_id'] = 'search' and page['item'] is not null"
    )
    return run.drained(spark, found, "src-sql-table")


def _user_capture(spark: SparkSession, d: str, initial: bool) -> DataFrame:
    """Snapshot of one table and its later changes in one topic, read as a stream."""
    snapshot = change_sources.snapshot_envelopes(bind.user_table(spark, d), bind.TOPIC_PREFIX + bind.USERS)
    path = run.stored(spark, snapshot, "changes")
    tail = bind.user_changes(spark, d).where(F.col("offset") % 3 > 0)
    tail.write.mode("append").parquet(path)
    captured = change_sources.read_changes(
        spark, topics="capture[.]shop[.]user_info", format="parquet", path=path, initial=initial
    )
    return run.drained(spark, captured, "src-changes")


@query
def src_changes(spark, d):
    return _user_capture(spark, d, initial=True)


@query
def src_changes_tail(spark, d):
    return _user_capture(spark, d, initial=False)


@query
def changelog_table(spark, d):
    normal = changes.normalize(bind.user_changes(spark, d), keep=("offset",))
    shape = changes.dimension_schema("id,name,segment,nation")
    change_sources.changelog_table(normal, "user_now", shape)
    return spark.sql("select * from user_now")


@query
def stream_changelog(spark, d):
    """The changed table kept up to date from a stream, deletes included."""
    envelopes = bind.user_changes(spark, d)
    step = F.col("offset") % 3
    path = fresh_dir(spark, "user-changes")
    for number in range(3):
        envelopes.where(step == number).write.mode("append").parquet(path)
    stream = (
        spark.readStream.schema(change_sources.CHANGE_COLUMNS)
        .option("maxFilesPerTrigger", 1).parquet(path)
    )
    shape = changes.dimension_schema("id,name,segment,nation")
    out = fresh_dir(spark, "user-now")
    write = table_sinks.dimension_writer(
        f"{out}/table", "id", shape, lambda batch: changes.last_images(batch, shape)
    )
    run.drain_to_batches(
        changes.normalize(stream, keep=("offset",)), write, f"{out}/checkpoint"
    )
    return table_sinks.read_current(spark, f"{out}/table", shape, "id")


@query
def src_csv_lines(spark, d):
    path = run.stored(spark, bind.sensor_lines(spark, d), "sensor-lines", "text")
    lines = topic_sources.read_topic(spark, "sensors", format="text", path=path)
    split = topic_sources.split_lines(lines).withColumn("vc", F.col("vc").cast("long"))
    return run.drained(spark, split, "src-csv")


@query
def dim_read(spark, d):
    return table_sources.read_dimension(spark, run.stored(spark, bind.dim_sku(spark, d), "dim"))


@query
def jdbc_rename(spark, d):
    balance = F.col("c_acctbal").cast("decimal(16,2)")
    return camel_columns(bind.table(spark, d, "customer").withColumn("c_acctbal", balance))


@query
def src_log_files(spark, d):
    lines = bind.raw_log_of(bind.page_log(spark, d)).join(
        bind.page_log(spark, d).select("event_id", F.to_date(millis_time("ts")).alias("day")),
        "event_id",
    )
    path = fresh_dir(spark, "log-files")
    lines.select("value", "day").write.partitionBy("day").text(path)
    read = topic_sources.log_files(spark, path)
    return run.drained(spark, read.select("log_day", "value"), "src-log-files")


# Sinks


@query
def sink_topic(spark, d):
    path = run.stored(spark, bind.page_log(spark, d), "pages")
    stream = topic_sources.read_topic(
        spark, "pages", format="parquet", path=path, schema=bind.page_log(spark, d).schema
    )
    out = fresh_dir(spark, "sink-topic")
    topic_sinks.write_topic(
        logs.to_json_rows(stream.drop("event_id")), f"{out}/checkpoint", topic="dwd_page_log",
        format="text", path=f"{out}/out", available_now=True,
    ).awaitTermination()
    return spark.read.text(f"{out}/out")


def _change_stream(spark: SparkSession, d: str) -> DataFrame:
    path = run.stored(spark, bind.raw_changes(spark, d), "changes")
    return change_sources.read_changes(
        spark, topics=".*", format="parquet", path=path, stream=True
    )


@query
def route_to_topics(spark, d):
    normal = changes.normalize(_change_stream(spark, d), keep=("offset",))
    routed = changes.route(changes.drop_deletes(normal), bind.rules(spark))
    facts = changes.routed_facts(routed).select(
        F.col("sinkTable").alias("topic"), F.to_json("after").alias("value")
    )
    out = fresh_dir(spark, "routed")
    topic_sinks.write_topic(
        facts, f"{out}/checkpoint", format="parquet", path=f"{out}/out", available_now=True
    ).awaitTermination()
    shape = "value string, topic string"
    return spark.read.schema(shape).parquet(f"{out}/out")


def _visitor_sums(spark: SparkSession, own: SparkSession, d: str) -> tuple[dict, Callable]:
    """The three streams of the visitor flow, and their statistics over the union of all."""
    flow = flows.visit_flow(flows.repaired_pages(spark, d), DURATIONS)
    frames = {"pages": flow.pages, "visits": flow.visits, "bounces": flow.bounces}

    def plan(streams: dict[str, DataFrame]) -> DataFrame:
        rows = stats.visitor_rows(streams["pages"], streams["visits"], streams["bounces"])
        return stats.visitor_stats(rows, DURATIONS.visitor_window, "7 hours")

    return frames, plan


@query
def sink_stats(spark, d):
    own = stream_session(spark)
    frames, plan = _visitor_sums(spark, own, d)
    streams = {}
    for name, frame in frames.items():
        path = run.stored(spark, frame, name)
        streams[name] = topic_sources.read_topic(own, name, format="parquet", path=path, schema=frame.schema)
    sums = plan(streams)
    out = fresh_dir(spark, "visitor-stats")
    write = table_sinks.stats_writer(f"{out}/table", schemas.VISITOR_STATS_COLUMNS)
    run.drain_to_batches(sums, write, f"{out}/checkpoint")
    return spark.read.schema(sums.schema).parquet(f"{out}/table").drop("batch_id")


@query
def sink_print(spark, d):
    """A stream shown row by row; here the shown rows are written by the tasks, to be looked at."""
    pages = bind.page_log(spark, d).select("event_id", "common.mid", "page.page_id")
    path = run.stored(spark, pages, "page-log")
    stream = spark.readStream.schema(pages.schema).parquet(path)
    tag = f"pages_{uuid.uuid4().hex}"
    out = fresh_dir(spark, "print")
    shown = topic_sinks.print_rows(
        stream, f"{out}/checkpoint", tag, format="parquet", available_now=True, path=f"{out}/shown"
    )
    shown.awaitTermination()
    return spark.read.schema(pages.schema).parquet(f"{out}/shown")


@query
def sink_drop_cols(spark, d):
    return table_sinks.without(flows.product_measures(spark, d), ["id_kind", "id", "ts"])


@query
def dim_upsert(spark, d):
    """New users first and then their changes, as micro-batches into a versioned table."""
    envelopes = bind.user_changes(spark, d)
    updates = F.col("offset") % 3 == 1
    path = run.stored(spark, envelopes.where(F.col("offset") % 3 == 0), "user-changes")
    envelopes.where(updates).write.mode("append").parquet(path)
    stream = (
        spark.readStream.schema(change_sources.CHANGE_COLUMNS)
        .option("maxFilesPerTrigger", 1).parquet(path)
    )
    routed = changes.route(
        changes.drop_deletes(changes.normalize(stream, keep=("offset",))), bind.rules(spark)
    )
    columns = "id,name,segment"
    shape = changes.dimension_schema(columns)
    out = fresh_dir(spark, "dim-user")
    write = table_sinks.dimension_writer(
        f"{out}/dim", "id", shape,
        lambda batch: changes.dimension_rows(batch, "dim_user_info", columns),
        compact_every=2,
    )
    run.drain_to_batches(routed, write, f"{out}/checkpoint")
    return table_sinks.read_current(spark, f"{out}/dim", shape, "id")


@query
def dim_schema_from_rule(spark, d):
    """Columns, key and rows of a dimension as its rule gives them."""
    shape, key = changes.rule_shape(bind.rules(spark), "dim_user_info")
    return changes.dimension_of(changes.routed_dimensions(_routed(spark, d)), "dim_user_info", shape, key)


# Changes and rules


@query
def cdc_normalize(spark, d):
    return _maps_as_text(_normal(spark, d), "before", "after")


@query
def cdc_normalize_reads(spark, d):
    """The older form, which leaves snapshot rows as reads."""
    normal = changes.normalize(
        bind.raw_changes(spark, d), keep=("offset",), map_read_to_insert=False
    )
    return _maps_as_text(normal, "before", "after")


@query
def cdc_drop_deletes(spark, d):
    return _maps_as_text(changes.drop_deletes(_normal(spark, d)), "before", "after")


@query
def rules_latest(spark, d):
    normal = changes.normalize(bind.rule_changes(spark, d), keep=("offset",))
    return changes.rules_from_changes(normal).drop("sink_pk", "sink_extend")


@query
def stream_route_rule_change(spark, d):
    """Orders in two batches; between them a change of the rule table sends them elsewhere."""
    base = fresh_dir(spark, "live-rules")
    history = changes.normalize(bind.order_rule_changes(spark), keep=("offset",))
    orders_in = bind.order_changes(spark, d)

    def rules_now(own: SparkSession) -> DataFrame:
        known = own.read.schema(history.schema).parquet(f"{base}/rules")
        return changes.rules_from_changes(known)

    def facts(batch: DataFrame, batch_id: int) -> None:
        rows = changes.routed_facts(batch).select(
            F.col("sinkTable").alias("topic"), F.to_json("after").alias("value"))
        rows.write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    for number in range(2):
        history.where(F.col("offset") == number).write.mode("append").parquet(f"{base}/rules")
        orders_in.where(F.col("offset") % 2 == number).write.mode("append").parquet(f"{base}/in")
        stream = change_sources.read_changes(spark, topics=".*", format="parquet", path=f"{base}/in")
        run.drain_to_batches(
            changes.normalize(stream, keep=("offset",)), routed_batches(rules_now, facts),
            f"{base}/checkpoint",
        )
    return spark.read.schema("topic string, value string").parquet(f"{base}/out").drop("batch_id")


@query
def stream_dim_from_new_rule(spark, d):
    """User changes in three batches; the rules that call for the dimension come with the second and third."""
    base = fresh_dir(spark, "new-dimension")
    history = changes.normalize(bind.dimension_rule_changes(spark), keep=("offset",))
    users = bind.user_changes(spark, d)
    odd, updated = F.floor(F.col("offset") / 3) % 2 == 1, F.col("offset") % 3 == 1
    parts = [~updated & ~odd, ~updated & odd, updated]
    prefix = f"d{uuid.uuid4().hex}_"

    def rules_now(own: SparkSession) -> DataFrame:
        return changes.rules_from_changes(own.read.schema(history.schema).parquet(f"{base}/rules"))

    for number, part in enumerate(parts):
        history.where(F.col("offset") == number).write.mode("append").parquet(f"{base}/rules")
        users.where(part).write.mode("append").parquet(f"{base}/in")
        stream = change_sources.read_changes(spark, topics=".*", format="parquet", path=f"{base}/in")
        run.drain_to_batches(
            changes.normalize(stream, keep=("offset",)), dimension_batches(rules_now, f"{base}/dims", prefix),
            f"{base}/checkpoint",
        )
    return current_dimension(spark, f"{prefix}dim_user_info")


@query
def cdc_route_fact(spark, d):
    facts = changes.routed_facts(_routed(spark, d))
    return _maps_as_text(facts, "after").select("offset", "tableName", "type", "sinkTable", "after")


@query
def cdc_route_dim(spark, d):
    dims = changes.routed_dimensions(_routed(spark, d))
    return _maps_as_text(dims, "after").select("offset", "tableName", "type", "sinkTable", "after")


@query
def cdc_project(spark, d):
    cut = changes.keep_columns("after", F.lit("id,name,user_id"))
    return _normal(spark, d).select("tableName", "offset", "type", F.to_json(cut).alias("after"))


@query
def dim_refresh(spark, d):
    """Orders in two batches; the user dimension is rewritten between them."""
    orders_in = bind.order_info(spark, d).select("id", "user_id", "create_time")
    early = F.col("create_time") < "1998-01-01"
    base = fresh_dir(spark, "refresh")
    users = bind.dim_user(spark, d).select("id", "gender")
    shape = users.schema
    rename = table_sinks.dimension_writer(f"{base}/dim", "id", shape, lambda batch: batch)

    def look_up(batch: DataFrame) -> DataFrame:
        now = table_sinks.read_current(batch.sparkSession, f"{base}/dim", shape, "id")
        return joins.enrich(batch, now, "user_id", {"user_gender": "gender"})

    write = fresh_lookup(
        look_up,
        table_sinks.stats_writer(f"{base}/out", ["id", "user_id", "create_time", "user_gender"]),
    )
    for number, part in enumerate([early, ~early]):
        rename(users.withColumn("gender", F.concat("gender", F.lit(str(number)))), number)
        orders_in.where(part).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(orders_in.schema).parquet(f"{base}/in")
        run.drain_to_batches(stream, write, f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").drop("batch_id")


# Logs


@query
def log_dirty(spark, d):
    return logs.dirty_lines(_parsed(spark, d))


@query
def log_clean(spark, d):
    return flat(logs.clean_logs(_parsed(spark, d)), "start")


@query
def log_start(spark, d):
    return flat(logs.start_logs(logs.clean_logs(_parsed(spark, d))), "start")


@query
def log_page(spark, d):
    return flat(logs.page_logs(logs.clean_logs(_parsed(spark, d))))


@query
def log_display(spark, d):
    return logs.display_logs(logs.page_logs(logs.clean_logs(_parsed(spark, d))), ("event_id",))


@query
def log_fanout(spark, d):
    lines = bind.raw_log(spark, d)
    path = run.stored(spark, lines, "raw-log")
    own = stream_session(spark)
    stream = topic_sources.read_topic(
        own, "ods_base_log", format="parquet", path=path, schema=lines.schema
    )
    out = fresh_dir(spark, "log-fanout")
    shape = logs.fan_out(logs.parse_log(lines), TOPICS, ("event_id",)).schema

    def write(batch: DataFrame, batch_id: int) -> None:
        messages = logs.fan_out(batch, TOPICS, ("event_id",))
        messages.write.mode("overwrite").partitionBy("topic").parquet(f"{out}/out/batch_id={batch_id}")

    with _claim_table(spark) as claim_table:
        run.drain_to_batches(logs.parse_log(stream), claims.repairing(claim_table, write), f"{out}/checkpoint")
    return spark.read.schema(shape).parquet(f"{out}/out").drop("batch_id")


@contextmanager
def _claim_table(spark: SparkSession) -> Iterator[str]:
    """A table of first claims for the time of a query."""
    name = f"first_claims_{uuid.uuid4().hex}"
    claims.create_claims(spark, name, buckets=8)
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE {name}")


@query
def to_json(spark, d):
    return logs.to_json_rows(bind.page_log(spark, d).drop("event_id"))


@query
def new_visitor_fix(spark, d):
    return logs.repair_new_flag(bind.page_log(spark, d)).select(
        "event_id", "common.mid", "common.is_new"
    )


# Visits


@query
def unique_visit(spark, d):
    return flat(visits.unique_visits(bind.page_log(spark, d)))


def _bounces(spark: SparkSession, d: str) -> DataFrame:
    return visits.bounce_details(bind.page_log(spark, d), DURATIONS.bounce_timeout)


@query
def bounce_matched(spark, d):
    found = _bounces(spark, d).where(F.col("bounce_kind") == visits.MATCHED)
    return flat(found).select("event_id", "mid", "page_id", "ts")


@query
def bounce_timeout(spark, d):
    found = _bounces(spark, d).where(F.col("bounce_kind") == visits.TIMED_OUT)
    return flat(found).select("event_id", "mid", "page_id", "ts")


@query
def bounce_detail(spark, d):
    return flat(_bounces(spark, d), "bounce_kind")


# Orders, lookups, joins


@query
def order_parse(spark, d):
    parsed = orders.parse_orders(bind.order_info(spark, d))
    return orders.good_times(parsed).select(
        "id", "create_time", "create_date", "create_hour", "create_ts"
    )


@query
def order_parse_dirty(spark, d):
    """Orders whose time text is broken go to the dirty table."""
    shaky = _shaky(bind.order_info(spark, d))
    return orders.bad_times(orders.parse_orders(shaky)).select("id", "create_time")


def _shaky(rows: DataFrame) -> DataFrame:
    """Every ninth row has a time text that nobody can read."""
    broken = F.when(F.col("id") % 9 == 0, F.concat(F.lit("on "), "create_time"))
    return rows.withColumn("create_time", F.coalesce(broken, F.col("create_time")))


@query
def order_flow_dirty(spark, d):
    """What the order, detail and payment inputs of the wide records leave behind."""
    return flows.dirty_times({
        "order": _shaky(bind.order_info(spark, d)), "detail": _shaky(bind.order_detail(spark, d)),
        "payment": _shaky(bind.payment_info(spark, d)),
    }, "id")


@query
def order_wide_join(spark, d):
    return flows.joined_orders(spark, d).drop("split_feight_fee", "expire_time", "operate_time")


@query
def order_wide(spark, d):
    return flows.wide_orders(spark, d)


@query
def payment_wide(spark, d):
    return flows.wide_payments(spark, d)


@query
def wide_coalesce(spark, d):
    """Two frames of wide orders; the gaps of one, in each field at other rows, are filled from the other."""
    joined = flows.joined_orders(spark, d).select("detail_id", *orders.MERGED_FIELDS)
    # The given details repeat ids, so the rows of an id are told apart by a number.
    same = Window.partitionBy("detail_id").orderBy(*orders.MERGED_FIELDS)
    whole = joined.withColumn("n", F.row_number().over(same))
    full = spark.read.schema(whole.schema).parquet(run.stored(spark, whole, "wide-orders"))
    gaps = full.select("detail_id", "n", *[
        F.when(F.col("detail_id") % (n + 2) > 0, F.col(name)).alias(name)
        for n, name in enumerate(orders.MERGED_FIELDS)
    ])
    return orders.first_non_null(gaps, full, ["detail_id", "n"], own_only=orders.OWN_FIELDS).drop("n")


def _details(spark: SparkSession, d: str) -> DataFrame:
    return bind.order_detail(spark, d).select("order_id", "sku_id", "sku_num")


@query
def enrich(spark, d):
    """The generic lookup; half of the dimension is missing, so many rows pass unmatched."""
    cheap = bind.dim_sku(spark, d).where(F.col("price").try_cast("decimal(16,2)") < 950)
    return joins.enrich(_details(spark, d), cheap, "sku_id", {"price": "price"})


@query
def enrich_user(spark, d):
    base = bind.order_info(spark, d).select("id", "user_id")
    return orders.add_user(base, bind.with_bad_id(bind.dim_user(spark, d)), bind.AS_OF)


@query
def enrich_province(spark, d):
    base = bind.order_info(spark, d).select("id", "province_id")
    return orders.add_province(base, bind.with_bad_id(bind.dim_province(spark, d)))


def _with_sku(spark: SparkSession, d: str) -> DataFrame:
    take = {
        "sku_name": "sku_name", "sku_price": F.col("price").cast("decimal(16,2)"),
        **{n: F.col(n).cast("long") for n in ("spu_id", "tm_id", "category3_id")},
    }
    return joins.enrich(_details(spark, d), bind.with_bad_id(bind.dim_sku(spark, d)), "sku_id", take)


@query
def enrich_sku(spark, d):
    return _with_sku(spark, d)


@query
def enrich_spu(spark, d):
    base = _with_sku(spark, d).select("order_id", "sku_id", "spu_id")
    return joins.enrich(base, bind.with_bad_id(bind.dim_spu(spark, d)), "spu_id", {"spu_name": "spu_name"})


@query
def enrich_tm(spark, d):
    base = _with_sku(spark, d).select("order_id", "sku_id", "tm_id")
    tm = bind.with_bad_id(bind.dim_trademark(spark, d))
    return joins.enrich(base, tm, "tm_id", {"tm_name": "tm_name"})


@query
def enrich_category3(spark, d):
    base = _with_sku(spark, d).select("order_id", "sku_id", "category3_id")
    return joins.enrich(
        base, bind.with_bad_id(bind.dim_category3(spark, d)), "category3_id", {"category3_name": "name"}
    )


_SENSOR_KEY, _SENSOR_TIME = {"id": "id"}, ("ts", "ts")


@query
def interval_join_pairs(spark, d):
    return joins.interval_join(
        bind.sensors(spark, d, "view"), bind.sensors(spark, d, "click"),
        _SENSOR_KEY, _SENSOR_TIME, -SENSOR_BOUND, SENSOR_BOUND,
    )


def _ttl(spark: SparkSession, d: str, how: str) -> DataFrame:
    return joins.ttl_join(
        bind.sensors(spark, d, "view"), bind.sensors(spark, d, "click"),
        _SENSOR_KEY, _SENSOR_TIME, SENSOR_BOUND, how,
    )


@query
def ttl_join_inner(spark, d):
    return _ttl(spark, d, "inner")


@query
def ttl_join_left(spark, d):
    return _ttl(spark, d, "left")


@query
def ttl_join_right(spark, d):
    return _ttl(spark, d, "right")


@query
def ttl_join_full(spark, d):
    return _ttl(spark, d, "full")


# Keywords


@query
def keyword_tokens(spark, d):
    """Tokens through the SQL table function."""
    register_keyword_function(spark)
    bind.product_titles(spark, d).createOrReplaceTempView("product_title")
    return spark.sql(
        "select t.sku_id, k.keyword from product_title t, lateral keyword_tokens(t.title) k"
    )


@query
def keyword_tokens_han(spark, d):
    words = word_list(spark, bind.HAN_WORDS)
    return keyword_rows(bind.han_titles(spark, d), "title", words=words).select("sku_id", "keyword")


@query
def keyword_token_counts(spark, d):
    """Tokens of every document, counted."""
    tokens = keyword_rows(bind.table(spark, d, "documents").select("text"), "text")
    return tokens.groupBy("keyword").agg(F.count("*").alias("ct"))


@query
def keyword_search_rows(spark, d):
    return stats.search_rows(bind.page_log(spark, d))


@query
def keyword_stats(spark, d):
    return flows.keyword_stats(spark, d).drop("ts")


# Statistics


@query
def visitor_rows(spark, d):
    return flows.visit_flow(flows.repaired_pages(spark, d), DURATIONS).rows()


@query
def visitor_rows_literal(spark, d):
    """Sessions counted by the rule the original code applies."""
    return flows.visit_flow(flows.repaired_pages(spark, d), DURATIONS).rows(literal=True)


@query
def visitor_stats(spark, d):
    return flows.visitor_stats(spark, d)


@query
def product_click(spark, d):
    return stats.click_rows(bind.page_log(spark, d)).select("sku_id", "ts", "click_ct")


@query
def product_display(spark, d):
    return stats.display_rows(bind.page_log(spark, d)).select("sku_id", "ts", "display_ct")


@query
def product_rows(spark, d):
    return flows.product_measures(spark, d)


@query
def product_rows_dirty(spark, d):
    return flows.product_dirty(spark, d)


@query
def product_stats(spark, d):
    return flows.product_stats(spark, d)


def _one_more(kept: PeriodStatistics, name: str, rows: DataFrame) -> DataFrame:
    """Statistics of all days but the last, then brought up to date with that day."""
    path = run.stored(rows.sparkSession, rows, "period-input")
    rows = rows.sparkSession.read.schema(rows.schema).parquet(path)
    day = millis_date("ts")
    last = rows.agg(F.max(day)).first()[0]
    for number, part in enumerate([day < F.lit(last), day == F.lit(last)]):
        kept.add(number, **{name: rows.where(part)})
    return kept.table().drop(PERIOD)


@query
def stats_one_day_more(spark, d):
    """Product statistics by period; the last day comes after all others."""
    rows = flows.product_measures(spark, d)
    kept = flows.product_by_period(spark, d, fresh_dir(spark, "kept-product"), schema=rows.schema)
    return _one_more(kept, "rows", rows)


@query
def stats_visitor_day_more(spark, d):
    pages = flows.repaired_pages(spark, d)
    kept = flows.visitor_by_period(spark, pages, fresh_dir(spark, "kept-visitor"))
    return _one_more(kept, "pages", pages)


@query
def province_stats(spark, d):
    return flows.province_stats(spark, d).drop("ts")


# Reports


@query
def report_gmv(spark, d):
    return reports.gross_sales(flows.statistics(spark, d, "product"), SALES_FROM, SALES_TO)


@query
def report_trademark(spark, d):
    return reports.by_trademark(flows.statistics(spark, d, "product"), SALES_FROM, SALES_TO)


@query
def report_trademark_series(spark, d):
    return _series_text(reports.trademark_series(flows.statistics(spark, d, "product"), SALES_FROM, SALES_TO))


def _series_text(series: DataFrame) -> DataFrame:
    return series.select(
        F.array_join("categories", ",").alias("categories"),
        F.array_join(F.transform("data", lambda x: x.cast("string")), ",").alias("data"),
    )


@query
def report_category3(spark, d):
    return reports.by_category3(flows.statistics(spark, d, "product"), SALES_FROM, SALES_TO)


@query
def report_spu(spark, d):
    return reports.by_spu(flows.statistics(spark, d, "product"), SALES_FROM, SALES_TO)


@query
def report_province(spark, d):
    return reports.by_province(flows.statistics(spark, d, "province"), SALES_FROM, SALES_TO)


@query
def report_visitor(spark, d):
    return reports.by_new_flag(flows.statistics(spark, d, "visitor"), VISIT_DAY)


@query
def report_visitor_default_day(spark, d):
    """No day is named, so the clock gives it."""
    return reports.by_new_flag(flows.statistics(spark, d, "visitor"), now=bind.VISIT_DATE)


@query
def report_visitor_rates(spark, d):
    return reports.visitor_rates(flows.statistics(spark, d, "visitor"), VISIT_DAY)


@query
def report_hourly(spark, d):
    return reports.by_hour(flows.statistics(spark, d, "visitor"), VISIT_DAY)


@query
def report_hourly_filled(spark, d):
    return reports.hours_filled(flows.statistics(spark, d, "visitor"), VISIT_DAY)


@query
def report_keyword(spark, d):
    return reports.keyword_scores(flows.statistics(spark, d, "keyword"), VISIT_DAY)


def _default_day(name: str, statistics: str, report: Callable[..., DataFrame], now: str) -> None:
    """A query that names no day, so the clock gives it; the clock stands at ``now``."""

    def ask(spark: SparkSession, d: str) -> DataFrame:
        return report(flows.statistics(spark, d, statistics), now=now)

    _registry[f"{name}_default_day"] = ask


for _name, _statistics, _report, _now in [
    ("report_gmv", "product", reports.gross_sales, SALES_DATE),
    ("report_trademark", "product", reports.by_trademark, SALES_DATE),
    ("report_category3", "product", reports.by_category3, SALES_DATE),
    ("report_spu", "product", reports.by_spu, SALES_DATE),
    ("report_trademark_series", "product", lambda rows, now: _series_text(reports.trademark_series(rows, now=now)), SALES_DATE),
    ("report_province", "province", reports.by_province, SALES_DATE),
    ("report_visitor_rates", "visitor", reports.visitor_rates, bind.VISIT_DATE),
    ("report_hourly", "visitor", reports.by_hour, bind.VISIT_DATE),
    ("report_hourly_filled", "visitor", reports.hours_filled, bind.VISIT_DATE),
    ("report_keyword", "keyword", reports.keyword_scores, bind.VISIT_DATE),
]:
    _default_day(_name, _statistics, _report, _now)


# Streaming forms


def _from_pages(
    spark: SparkSession, d: str, name: str, plan: Callable[[DataFrame], DataFrame], idle_batches: bool = True
) -> DataFrame:
    """A plan over the page log as it comes in several runs, in order of time."""
    pages = {"pages": bind.page_log(spark, d)}
    own = stream_session(spark, idle_batches=idle_batches)
    return run.drained_in_order(
        spark, own, pages, {"pages": "ts"}, lambda s: plan(s["pages"]), name
    )


@query
def stream_new_visitor_fix(spark, d):
    """The page log in several runs; each goes on from the first claims that the others stored."""
    base = fresh_dir(spark, "new-visitors")
    pages = bind.page_log(spark, d)
    own = stream_session(spark)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("event_id", "common.mid", "common.is_new")
        rows.write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    with _claim_table(spark) as claim_table:
        for part in run.in_order_of_time(spark, {"pages": pages}, {"pages": "ts"}, f"{base}/in"):
            stream = own.readStream.schema(pages.schema).parquet(part["pages"])
            run.drain_to_batches(stream, claims.repairing(claim_table, write, merge_every=2), f"{base}/checkpoint")
    return spark.read.schema("event_id long, mid string, is_new string").parquet(f"{base}/out").drop("batch_id")


@query
def stream_unique_visit(spark, d):
    return _from_pages(spark, d, "unique-visits", lambda pages: flat(
        stream_visits.unique_visits(pages)), idle_batches=False)


@query
def stream_bounce_detail(spark, d):
    return _from_pages(spark, d, "bounces", lambda pages: flat(
        stream_visits.bounce_details(pages, DURATIONS.bounce_timeout), "bounce_kind"))


@query
def stream_visitor_stats(spark, d):
    own = stream_session(spark)
    frames, plan = _visitor_sums(spark, own, d)
    return run.drained_in_order(spark, own, frames, dict.fromkeys(frames, "ts"), plan, "visitor-stats")


@query
def stream_product_stats(spark, d):
    """Statistics over a union of streams, one per kind of input, with the watermark after it.

    Each micro-batch gives the windows that its watermark closes; the rows of open ones are kept for the next.
    """
    rows = flows.product_measures(spark, d)
    kinds = F.when(F.col("id_kind").isNotNull(), F.col("id_kind")).when(
        F.col("click_ct") + F.col("display_ct") > 0, "page").otherwise("other")
    layer = run.stored(spark, rows.withColumn("kind", kinds), "product-rows", partition_by=("kind",))
    stored = spark.read.schema(rows.schema.add("kind", "string")).parquet(layer)
    frames = {k: stored.where(F.col("kind") == k).drop("kind") for k in ("page", "other", "order", "paid", "refund")}
    # No state is kept by partition, so there may be many; a task's rows stay few if they are not merged.
    own = stream_session(spark, 4 * run.state_partitions(spark, stored.count()))
    own.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    # Rows combine in memory before the shuffle, so a task reads few files.
    own.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    # What a micro-batch has shuffled is of no use to the next one.
    own.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    dims = flows.snowflake(own, d)
    base = fresh_dir(spark, "product-stats")

    def plan(union: DataFrame) -> DataFrame:
        return stats.product_stats(union, dims, DURATIONS.product_window)

    def write(closed: DataFrame, batch_id: int) -> None:
        plan(closed).write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    closing = windows.closing("ts", DURATIONS.product_window, PRODUCT_DELAY, f"{base}/kept", write)
    for part in run.in_order_of_time(spark, frames, dict.fromkeys(frames, "ts"), f"{base}/in", written=True):
        streams = [own.readStream.schema(frame.schema).parquet(part[topic]) for topic, frame in frames.items()]
        run.drain_to_batches(reduce(DataFrame.unionByName, streams), closing, f"{base}/checkpoint")
    return spark.read.schema(plan(frames["page"]).schema).parquet(f"{base}/out").drop("batch_id")


def _joined_topics(
    spark: SparkSession, frames: dict[str, DataFrame], on: dict[str, str], time: str, bounds: tuple[int, int],
    name: str, plan: Callable[[DataFrame], DataFrame] = lambda pairs: pairs, **options: str,
) -> DataFrame:
    """A plan over the interval join of two topics that come in several runs, in order of time."""
    base = fresh_dir(spark, name)
    # No state is kept by partition, so there may be many; small ones are joined while a micro-batch runs.
    own = stream_session(spark, 16 * spark.sparkContext.defaultParallelism)
    times = (time, time)

    def write(pairs: DataFrame, batch_id: int) -> None:
        plan(pairs).write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    joining = stream_joins.interval_joining(on, times, *bounds, f"{base}/kept", write, **options)
    for part in run.in_order_of_time(spark, frames, dict.fromkeys(frames, time), f"{base}/in"):
        streams = [own.readStream.schema(frame.schema).parquet(part[topic]) for topic, frame in frames.items()]
        run.drain_to_batches(stream_joins.both_topics(*streams), joining, f"{base}/checkpoint")
    shape = plan(joins.interval_join(*frames.values(), on, times, *bounds)).schema
    return spark.read.schema(shape).parquet(f"{base}/out").drop("batch_id")


@query
def stream_order_wide(spark, d):
    frames = {
        "orders": orders.parse_orders(bind.order_info(spark, d)),
        "details": orders.parse_created(bind.order_detail(spark, d)),
    }
    bound = DURATIONS.order_bound

    def plan(pairs: DataFrame) -> DataFrame:
        wide = orders.merge_order_detail(pairs)
        return wide.drop("split_feight_fee", "expire_time", "operate_time")

    return _joined_topics(
        spark, frames, {"id": "order_id"}, "create_ts", (-bound, bound), "order-wide", plan, copy="left")


@query
def stream_payment_wide(spark, d):
    frames = {
        "payments": orders.parse_created(bind.payment_info(spark, d)),
        "orders": orders.parse_created(flows.wide_orders(spark, d)),
    }
    bounds = (DURATIONS.payment_lower, DURATIONS.payment_upper)
    return _joined_topics(
        spark, frames, {"order_id": "order_id"}, "create_ts", bounds, "payment-wide", orders.merge_payment, copy="left")


@query
def stream_province_stats(spark, d):
    wide = orders.add_province(flows.joined_orders(spark, d), bind.dim_province(spark, d))
    wide = wide.select(
        "order_id", "province_id", "split_total_amount", "province_name", "province_area_code",
        "province_iso_code", "province_3166_2_code", "create_time",
    )
    path = run.stored(spark, wide, "order-wide")
    own = stream_session(spark)
    stream = topic_sources.read_topic(
        own, "dwm_order_wide", format="parquet", path=path, schema=wide.schema
    )
    sums = stats.province_stats(stream, DURATIONS.product_window)
    return run.drained(spark, sums.drop("ts"), "province-stats")


@query
def stream_keyword_stats(spark, d):
    """The keyword job as SQL text over a topic table."""
    messages = logs.to_json_rows(bind.page_log(spark, d))
    path = run.stored(spark, messages, "page-topic", "text")
    own = stream_session(spark)
    stream = topic_sources.read_topic(own, "dwd_page_log", format="text", path=path)
    shape = _PAGE_MAP
    topic_sources.topic_table(stream, "page_log", shape, seconds_time("ts"))
    register_keyword_function(own)
    counts = own.sql(
        """
        select keyword, count(*) ct, 'SEARCH' source,
               date_format(window.start, 'yyyy-MM-dd HH:mm:ss') stt,
               date_format(window.end, 'yyyy-MM-dd HH:mm:ss') edt
        from (
            select p.rt, k.keyword
            from (select page['item'] key_word, rt from page_log
                  where page['last_page_id'] = 'search' and page['item'] is not null) p,
                 lateral keyword_tokens(p.key_word) k
        )
        group by keyword, window(rt, '1 hour')
        """
    )
    return run.drained(spark, counts, "keyword-stats")


def _stream_ttl(spark: SparkSession, d: str, how: str) -> DataFrame:
    frames = {kind: bind.sensors(spark, d, kind) for kind in ("view", "click")}
    bounds = (-SENSOR_BOUND, SENSOR_BOUND)
    return _joined_topics(spark, frames, _SENSOR_KEY, "ts", bounds, f"ttl-{how}", how=how)


@query
def stream_ttl_join_inner(spark, d):
    return _stream_ttl(spark, d, "inner")


@query
def stream_ttl_join_left(spark, d):
    return _stream_ttl(spark, d, "left")


@query
def stream_ttl_join_right(spark, d):
    return _stream_ttl(spark, d, "right")


@query
def stream_ttl_join_full(spark, d):
    return _stream_ttl(spark, d, "full")


def _expiring(spark: SparkSession, d: str, how: str, renew: bool) -> DataFrame:
    """Changes of a join of two streams that come in several runs, in order of time."""
    frames = {kind: bind.sensors(spark, d, kind) for kind in ("view", "click")}

    def plan(streams: dict[str, DataFrame]) -> DataFrame:
        return renewed.expiring_join(
            streams["view"], streams["click"], _SENSOR_KEY, _SENSOR_TIME, RENEWED_TTL if renew else SENSOR_BOUND,
            how, renew)

    own = stream_session(spark)
    return run.drained_in_order(spark, own, frames, dict.fromkeys(frames, "ts"), plan, f"expiring-{how}")


@query
def stream_ttl_renewed_left(spark, d):
    """Left rows live on as long as right rows keep reading them."""
    return renewed.live_rows(_expiring(spark, d, "left", renew=True))


@query
def stream_ttl_renewed_full(spark, d):
    return renewed.live_rows(_expiring(spark, d, "full", renew=True))


@query
def stream_outer_changes(spark, d):
    """Rows given out alone are taken back when their first partner comes."""
    return _expiring(spark, d, "full", renew=False)


def _two_runs(spark: SparkSession, first: DataFrame, second: DataFrame, name: str,
              plan: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a stream to its end, add files, and run it again from its checkpoint."""
    base = fresh_dir(spark, name)
    own = stream_session(spark)
    shape = None
    for part in (first, second):
        part.write.mode("append").parquet(f"{base}/in")
        result = plan(own.readStream.schema(part.schema).parquet(f"{base}/in"))
        shape = result.schema
        run.drain_to_files(result, f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(shape).parquet(f"{base}/out")


def _hourly_counts(pages: DataFrame) -> DataFrame:
    timed = stream_visits.with_event_time(pages, "5 seconds")
    counts = timed.groupBy(F.window("rt", "1 hour")).agg(F.count("*").alias("n"))
    return counts.select(time_text("window.start").alias("stt"), "n")


@query
def stream_restart(spark, d):
    pages = bind.page_log(spark, d)
    early = millis_time("ts") < "2024-01-15"
    return _two_runs(spark, pages.where(early), pages.where(~early), "restart", _hourly_counts)


@query
def late_rows(spark, d):
    """Error pages come after all others; those behind the watermark are dropped."""
    pages = bind.page_log(spark, d)
    late = F.col("page.page_id") == "error"
    return _two_runs(spark, pages.where(~late), pages.where(late), "late", _hourly_counts)
