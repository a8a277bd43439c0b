"""The benchmark tables read as the shop's topics, facts and dimensions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart import schemas
from tidemart.functions.times import time_text
from tidemart.session import configure

AS_OF = "2024-01-31"
VISIT_DATE = "2024-01-15"

TOPIC_PREFIX = "capture.shop."
USERS, ORDERS, PROVINCES, REGIONS = "user_info", "order_info", "base_province", "base_region"

# The routing rules the change queries run with.
RULES = [
    (USERS, "insert", "hbase", "dim_user_info", "id,name,segment", "id", None),
    (USERS, "update", "hbase", "dim_user_info", "id,name,segment", None, None),
    (ORDERS, "insert", "kafka", "dwd_order_info", "id,user_id,order_status", "id", None),
    (PROVINCES, "insert", "clickhouse", "province_copy", "id,name", "id", None),
    ("base_dictionary", "insert", "hbase", "dim_base_dictionary", "id,name", "id", None),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _moment(name: str) -> Column:
    """Stored wall-clock time as an instant of the session zone."""
    return F.col(name).cast("timestamp")


def _money(name: str) -> Column:
    return F.col(name).cast(schemas.MONEY)


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page records with their arrival number."""
    return page_log_of(table(spark, sf_dir, "events"))


def page_log_of(events: DataFrame) -> DataFrame:
    user, kind = F.col("user_id"), F.col("event_type")
    item = F.get_json_object("props", "$.k")
    came_from = F.when(kind.isin("signup", "view"), F.lit(None).cast("string")).otherwise(
        F.when(kind == "click", "search").otherwise("home")
    )
    second = (item.cast("int") + 1).cast("string")
    both = F.array(*[
        F.struct(shown.alias("item"), F.lit("sku_id").alias("item_type"))
        for shown in (item, second)
    ])
    shown = F.slice(both, F.lit(1), (F.col("event_id") % 3).cast("int"))
    return events.select(
        "event_id",
        F.struct(
            user.cast("string").alias("mid"),
            (user % 3).cast("string").alias("vc"),
            (user % 5).cast("string").alias("ch"),
            (user % 25).cast("string").alias("ar"),
            F.when(user % 2 == 0, "1").otherwise("0").alias("is_new"),
        ).alias("common"),
        F.struct(
            F.when(kind == "click", "good_detail").otherwise(kind).alias("page_id"),
            came_from.alias("last_page_id"),
            item.alias("item"),
            F.lit("sku_id").alias("item_type"),
            F.floor(F.col("value") * 1000).cast("long").alias("during_time"),
        ).alias("page"),
        shown.alias("displays"),
        F.unix_millis(_moment("ts")).alias("ts"),
    )


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines as text; some are cut short, lack ``common`` or ``ts``, or are start records."""
    return raw_log_of(page_log(spark, sf_dir))


def raw_log_of(pages: DataFrame) -> DataFrame:
    number = F.col("event_id")
    start = F.when(number % 50 == 0, F.struct(F.lit("icon").alias("entry")))
    common = F.when(number % 89 != 0, F.col("common"))
    time = F.when(number % 83 != 0, F.col("ts"))
    text = F.to_json(F.struct(
        common.alias("common"), "page", "displays", start.alias("start"), time.alias("ts")
    ))
    cut = F.when(number % 97 == 0, F.substring(text, 1, 40)).otherwise(text)
    return pages.select("event_id", cut.alias("value"))


def order_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders; the province is the nation of the customer, the hour follows the order key."""
    nation = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders")
    joined = orders.join(nation, F.col("o_custkey") == F.col("c_custkey"), "left")
    key, total = F.col("o_orderkey"), _money("o_totalprice")
    activity, coupon = (key % 7).cast(schemas.MONEY), (key % 5).cast(schemas.MONEY)
    return joined.select(
        key.alias("id"),
        F.col("c_nationkey").cast("long").alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        total.alias("total_amount"),
        activity.alias("activity_reduce_amount"),
        coupon.alias("coupon_reduce_amount"),
        (total + activity + coupon).cast(schemas.MONEY).alias("original_total_amount"),
        (key % 11).cast(schemas.MONEY).alias("feight_fee"),
        F.lit(None).cast("string").alias("expire_time"),
        time_text(_order_moment()).alias("create_time"),
        F.lit(None).cast("string").alias("operate_time"),
    )


def _order_moment() -> Column:
    hours = F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
    return _moment("o_orderdate") + hours


def _split_total() -> Column:
    rest = F.lit(1).cast("decimal(3,2)") - F.col("l_discount").cast("decimal(3,2)")
    return F.round(_money("l_extendedprice") * rest, 2).cast(schemas.MONEY)


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber").cast("long")
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + line).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        _money("l_extendedprice").alias("order_price"),
        F.col("l_quantity").cast("long").alias("sku_num"),
        F.concat(F.lit("sku "), F.col("l_partkey").cast("string")).alias("sku_name"),
        time_text(_moment("l_shipdate")).alias("create_time"),
        _split_total().alias("split_total_amount"),
        (line % 3).cast(schemas.MONEY).alias("split_activity_amount"),
        (line % 2).cast(schemas.MONEY).alias("split_coupon_amount"),
    )


def payment_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per finished order, zero to nineteen minutes after it."""
    key = F.col("o_orderkey")

    def later(minutes: Column) -> Column:
        wait = F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"))
        return time_text(_order_moment() + wait)

    return table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(
        key.alias("id"), key.alias("order_id"), F.col("o_custkey").alias("user_id"),
        _money("o_totalprice").alias("total_amount"),
        F.concat(F.lit("order "), key.cast("string")).alias("subject"),
        (F.lit(1101) + key % 3).cast("string").alias("payment_type"),
        later(key % 20).alias("create_time"),
        later(key % 20 + 1).alias("callback_time"),
    )


def refund_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
        _split_total().alias("refund_amount"),
        time_text(_moment("l_shipdate")).alias("create_time"),
    )


def comment_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = F.when(F.col("l_linestatus") == "F", "1201").otherwise("1203")
    return table(spark, sf_dir, "lineitem").where("l_returnflag = 'A'").select(
        F.col("l_partkey").alias("sku_id"), verdict.alias("appraise"),
        time_text(_moment("l_shipdate")).alias("create_time"),
    )


def _touched(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Times as a database writes them: some with a fraction, and some that nobody can read."""
    number, text = F.col("event_id"), time_text(_moment("ts"))
    written = (
        F.when(number % 71 == 0, F.concat(F.lit("on "), text))
        .when(number % 3 == 0, F.concat(text, F.lit(".5"))).otherwise(text)
    )
    return table(spark, sf_dir, "events").where(F.col("event_type") == kind).select(
        (number % 200).alias("sku_id"), written.alias("create_time"), "event_id"
    )


def favor_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _touched(spark, sf_dir, "click")


def cart_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _touched(spark, sf_dir, "purchase")


def dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    born = F.date_add(F.to_date(F.lit("1960-01-01")), (key % 15000).cast("int"))
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("id"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
        born.cast("string").alias("birthday"),
    )


def dim_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region")
    nations = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey").cast("string")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        key.alias("id"), F.col("n_name").alias("name"),
        F.concat(F.lit("area-"), key).alias("area_code"),
        F.concat(F.lit("CN-"), key).alias("iso_code"),
        F.concat(F.col("r_name"), F.lit("-"), key).alias("iso_3166_2"),
    )


def _name_id(column: str) -> Column:
    """Number for a name: the first 60 bits of its digest."""
    return F.conv(F.substring(F.md5(F.col(column).cast("binary")), 1, 15), 16, 10)


def _named(spark: SparkSession, sf_dir: str, column: str, name: str) -> DataFrame:
    """Dimension of the distinct names of a part column."""
    parts = table(spark, sf_dir, "part").select(F.col(column).alias(name)).distinct()
    return parts.select(_name_id(name).alias("id"), name)


def dim_spu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(spark, sf_dir, "p_name", "spu_name")


def dim_trademark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(spark, sf_dir, "p_brand", "tm_name")


def dim_category3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(spark, sf_dir, "p_type", "name")


def dim_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_size").cast("string")).alias("sku_name"),
        F.col("p_retailprice").cast("decimal(16,2)").cast("string").alias("price"),
        _name_id("p_type").alias("category3_id"),
        _name_id("p_name").alias("spu_id"),
        _name_id("p_brand").alias("tm_id"),
    )


def with_bad_id(dim: DataFrame) -> DataFrame:
    """A dimension with one more row, whose id is no number."""
    spark = dim.sparkSession
    return dim.unionByName(spark.createDataFrame([("x9",)], "id string"), allowMissingColumns=True)


def _envelope(source: DataFrame, name: str, op: Column, order: Column, row: Column,
              before: Column | None = None) -> DataFrame:
    """Capture envelopes of one table: (topic, offset, value)."""
    after = F.when(op != "d", row)
    old = F.when(op.isin("u", "d"), row) if before is None else before
    text = F.to_json(F.struct(
        old.alias("before"), after.alias("after"),
        F.struct(F.lit("shop").alias("db"), F.lit(name).alias("table")).alias("source"),
        op.alias("op"), order.alias("ts_ms"),
    ))
    return source.select(
        F.lit(TOPIC_PREFIX + name).alias("topic"), order.alias("offset"), text.alias("value")
    )


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a new row; every 7th is changed, every 31st deleted afterwards.

    Rows with a key that ends in 0 come from the first snapshot.
    """
    customers = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")

    def row(segment: Column) -> Column:
        return F.struct(
            key.alias("id"), F.col("c_name").alias("name"), segment.alias("segment"),
            F.col("c_nationkey").alias("nation"),
        )

    plain = F.col("c_mktsegment")
    changed = F.lower(plain)
    added = _envelope(
        customers, USERS, F.when(key % 10 == 0, "r").otherwise("c"), key * 3, row(plain)
    )
    updated = _envelope(
        customers.where(key % 7 == 0), USERS, F.lit("u"), key * 3 + 1, row(changed), row(plain)
    )
    deleted = _envelope(
        customers.where(key % 31 == 0), USERS, F.lit("d"), key * 3 + 2,
        row(F.when(key % 7 == 0, changed).otherwise(plain)),
    )
    return added.unionByName(updated).unionByName(deleted)


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    row = F.struct(
        key.alias("id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
    )
    return _envelope(table(spark, sf_dir, "orders"), ORDERS, F.lit("c"), key, row)


def place_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    provinces = _envelope(
        nation, PROVINCES, F.lit("c"), F.col("n_nationkey").cast("long"),
        F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")),
    )
    regions = _envelope(
        region, REGIONS, F.lit("c"), F.col("r_regionkey").cast("long"),
        F.struct(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")),
    )
    return provinces.unionByName(regions)


def raw_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts: list[Callable[[SparkSession, str], DataFrame]] = [
        user_changes, order_changes, place_changes,
    ]
    first, *rest = [part(spark, sf_dir) for part in parts]
    for part in rest:
        first = first.unionByName(part)
    return first


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, schemas.RULE)


def order_rule_changes(spark: SparkSession) -> DataFrame:
    """Two changes of the rule for orders: first all columns to one topic, then ids to another."""
    rows = [
        (n, (ORDERS, "insert", "kafka", table, columns))
        for n, (table, columns) in enumerate([
            ("dwd_order_info", "id,user_id,order_status"), ("dwd_order_ids", "id"),
        ])
    ]
    shape = "n long, r struct<source_table:string,operate_type:string,sink_type:string,sink_table:string,sink_columns:string>"
    frame = spark.createDataFrame(rows, shape)
    return _envelope(frame, "table_process", F.lit("c"), F.col("n"), F.col("r"))


def dimension_rule_changes(spark: SparkSession) -> DataFrame:
    """A rule for orders, then two rules of one after the other that call for a user dimension."""
    rows = [
        (0, (ORDERS, "insert", "kafka", "dwd_order_info", "id", None, None)),
        (1, (USERS, "insert", "hbase", "dim_user_info", "id,name,segment", "id", "SALT_BUCKETS = 4")),
        (2, (USERS, "update", "hbase", "dim_user_info", "id,name,segment", None, None)),
    ]
    fields = ", ".join(f"{f.name}:string" for f in schemas.RULE.fields).replace(" ", "")
    frame = spark.createDataFrame(rows, f"n long, r struct<{fields}>")
    return _envelope(frame, "table_process", F.lit("c"), F.col("n"), F.col("r"))


def user_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users' table as a snapshot finds it, before any of its changes."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"),
    )


def rule_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long history of rule changes, one per order: 40 tables, three operations."""
    key = F.col("o_orderkey")
    operation = (
        F.when(F.col("o_orderstatus") == "F", "insert")
        .when(F.col("o_orderstatus") == "O", "update").otherwise("delete")
    )
    row = F.struct(
        F.concat(F.lit("table_"), (F.col("o_custkey") % 40).cast("string")).alias("source_table"),
        operation.alias("operate_type"),
        F.when(key % 2 == 0, "kafka").otherwise("hbase").alias("sink_type"),
        F.concat(F.lit("sink_"), key.cast("string")).alias("sink_table"),
        F.lit("id,name").alias("sink_columns"),
    )
    return _envelope(table(spark, sf_dir, "orders"), "table_process", F.lit("c"), key, row)


def sensors(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """One side of the sensor demos: id, time in milliseconds, value in cents."""
    return table(spark, sf_dir, "events").where(F.col("event_type") == kind).select(
        F.col("user_id").cast("string").alias("id"),
        F.unix_millis(_moment("ts")).alias("ts"),
        F.floor(F.col("value") * 100).cast("long").alias("vc"),
        "event_id",
    )


def sensor_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor readings as comma-separated text lines."""
    both = sensors(spark, sf_dir, "view").unionByName(sensors(spark, sf_dir, "click"))
    return both.select(F.concat_ws(",", "id", "ts", "vc").alias("value"))


# Phrases of Chinese product titles, and a word list for them.
HAN_PHRASES = ["深空灰色", "移动联通电信4G手机", "双卡双待", "官方旗舰店"]
HAN_WORDS = ["移动", "联通", "移动联通", "电信", "手机", "双卡", "卡双", "待", "灰色"]


def han_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that mix Latin names with Chinese phrases."""
    phrases = F.array(*[F.lit(p) for p in HAN_PHRASES])
    key = F.col("p_partkey")
    pick = [F.get(phrases, (key % n).cast("int")) for n in (4, 3)]
    return table(spark, sf_dir, "part").select(
        key.alias("sku_id"), F.concat_ws(" ", "p_name", F.concat(*pick)).alias("title")
    )


def product_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("sku_id"),
        F.concat_ws(" ", "p_name", "p_brand", F.concat(F.col("p_size").cast("string"), F.lit("GB")))
        .alias("title"),
    )
