"""Measure rows and windowed statistics. All functions serve batch and stream alike.

Distinct counts are two-step aggregates: first one row per window, key and id, then the
count of those rows. Both steps combine before their shuffle, ids are never collected
into a set, and the same plan is allowed on a stream.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from tidemart import schemas
from tidemart.functions.codes import APPRAISE
from tidemart.functions.once import once
from tidemart.functions.text import keyword_rows
from tidemart.functions.times import millis_time, parse_millis, parse_time, seconds_time, time_text
from tidemart.operators.orders import add_province

TEN_SECONDS = "10 seconds"
ORDERED, PAID, REFUNDED = "order", "paid", "refund"

_MEASURES = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]


def _visitor(df: DataFrame, **measures: Column) -> DataFrame:
    zero = F.lit(0).cast("long")
    return df.select(
        *[F.col(f"common.{name}").alias(name) for name in ("vc", "ch", "ar", "is_new")],
        *[measures.get(name, zero).cast("long").alias(name) for name in _MEASURES],
        "ts",
    )


def visitor_rows(
    pages: DataFrame, visits: DataFrame, bounces: DataFrame, literal: bool = False
) -> DataFrame:
    """Measure rows of page views, unique visits and bounces.

    A session is counted at its entry page, which is what the bounce rate divides by.
    ``literal`` counts the pages that are no entry instead, as the original code does.
    """
    came_from = F.col("page.last_page_id")
    session = came_from.isNotNull() if literal else came_from.isNull()
    viewed = _visitor(
        pages, pv_ct=F.lit(1), sv_ct=F.when(session, 1).otherwise(0),
        dur_sum=F.coalesce(F.col("page.during_time"), F.lit(0)),
    )
    return viewed.unionByName(_visitor(visits, uv_ct=F.lit(1))).unionByName(
        _visitor(bounces, uj_ct=F.lit(1))
    )


def _bounds() -> list[Column]:
    return [time_text("window.start").alias("stt"), time_text("window.end").alias("edt")]


def visitor_stats(
    rows: DataFrame, width: str = TEN_SECONDS, delay: str = "5 seconds"
) -> DataFrame:
    """Sums per window, version, channel, area and new flag.

    On a stream ``delay`` must cover the bounce timeout and its disorder, or bounce rows
    come too late for their window.
    """
    timed = rows.withColumn("rt", millis_time("ts")).withWatermark("rt", delay)
    sums = timed.groupBy(F.window("rt", width), "vc", "ch", "ar", "is_new").agg(
        *[F.sum(name).alias(name) for name in _MEASURES], F.min("ts").alias("ts")
    )
    return sums.select("*", *_bounds()).select(*schemas.VISITOR_STATS_COLUMNS)


_COUNTS = [
    "display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num",
    "comment_ct", "good_comment_ct",
]
_AMOUNTS = ["order_amount", "payment_amount", "refund_amount"]
# What a measure row came from: the input's name, and its article and time as they were written.
_RAW = ["input", "raw_sku_id", "raw_time"]


def _product(
    df: DataFrame, source: Column | str, raw_time: str, ts: Column, kind: str | None = None, **values: Column
) -> DataFrame:
    zero = F.lit(0).cast("long")
    no_money = F.lit(0).cast(schemas.MONEY)
    return df.select(
        F.col("sku_id").try_cast("long").alias("sku_id"),
        ts.alias("ts"),
        *[F.coalesce(values.get(n, zero).cast("long"), zero).alias(n) for n in _COUNTS],
        *[F.coalesce(values.get(n, no_money), no_money).cast(schemas.MONEY).alias(n)
          for n in _AMOUNTS],
        F.lit(kind).cast("string").alias("id_kind"),
        (F.col("order_id") if kind else F.lit(None)).cast("long").alias("id"),
        (F.lit(source) if isinstance(source, str) else source).alias("input"),
        F.col("sku_id").cast("string").alias("raw_sku_id"),
        F.col(raw_time).cast("string").alias("raw_time"),
    )


def click_rows(pages: DataFrame) -> DataFrame:
    hit = (F.col("page.item_type") == "sku_id") & (F.col("page.page_id") == "good_detail")
    found = pages.where(hit).select(F.col("page.item").alias("sku_id"), "ts")
    return _product(found, "click", "ts", F.col("ts"), click_ct=F.lit(1))


def display_rows(pages: DataFrame) -> DataFrame:
    shown = pages.select(F.explode("displays").alias("_d"), "ts")
    shown = shown.where(F.col("_d.item_type") == "sku_id")
    return _product(
        shown.select(F.col("_d.item").alias("sku_id"), "ts"), "display", "ts", F.col("ts"),
        display_ct=F.lit(1),
    )


def _seen() -> Column:
    """The articles a page record clicked or displayed."""
    page = F.col("page")
    hit = (page["item_type"] == "sku_id") & (page["page_id"] == "good_detail")

    def seen(item: Column, click: int) -> Column:
        return F.struct(item.alias("sku_id"), F.lit(click).alias("click"))

    clicked = F.when(hit, F.array(seen(page["item"], 1))).otherwise(
        F.array().cast("array<struct<sku_id:string,click:int>>")
    )
    shown = F.transform(
        F.filter(
            F.coalesce(F.col("displays"), F.array()), lambda d: d["item_type"] == "sku_id"
        ),
        lambda d: seen(d["item"], 0),
    )
    return F.concat(clicked, shown)


def click_and_display_rows(pages: DataFrame) -> DataFrame:
    """Both kinds from one scan of the page log."""
    rows = pages.select(F.explode(_seen()).alias("_s"), "ts").select("_s.*", "ts")
    return _product(
        rows, F.when(F.col("click") == 1, "click").otherwise("display"), "ts", F.col("ts"),
        click_ct=F.col("click"), display_ct=1 - F.col("click"),
    )


def product_rows(
    pages: DataFrame, favors: DataFrame, carts: DataFrame, orders: DataFrame,
    payments: DataFrame, refunds: DataFrame, comments: DataFrame,
) -> DataFrame:
    """Measure rows of the seven inputs; ``orders`` and ``payments`` are wide rows."""
    created = once(parse_millis("create_time"))
    good = F.when(F.col("appraise") == APPRAISE["good"], 1).otherwise(0)
    parts = [
        _product(favors, "favor", "create_time", created, favor_ct=F.lit(1)),
        _product(carts, "cart", "create_time", created, cart_ct=F.lit(1)),
        _product(
            orders, "order", "create_time", created, ORDERED,
            order_amount=F.col("split_total_amount"), order_sku_num=F.col("sku_num"),
        ),
        _product(
            payments, "payment", "payment_create_time", once(parse_millis("payment_create_time")), PAID,
            payment_amount=F.col("split_total_amount"),
        ),
        _product(
            refunds, "refund", "create_time", created, REFUNDED, refund_amount=F.col("refund_amount")
        ),
        _product(
            comments, "comment", "create_time", created, comment_ct=F.lit(1), good_comment_ct=good
        ),
    ]
    rows = click_and_display_rows(pages)
    for part in parts:
        rows = rows.unionByName(part)
    return rows


def complete(rows: DataFrame) -> DataFrame:
    """Measure rows with a time and, where they have an article, a readable one."""
    return rows.where(_usable(rows)).drop(*_RAW)


def incomplete(rows: DataFrame) -> DataFrame:
    """Measure rows that no window or article can take; they belong to a dirty table."""
    return rows.where(~_usable(rows))


def product_dirty(
    pages: DataFrame, favors: DataFrame, carts: DataFrame, orders: DataFrame,
    payments: DataFrame, refunds: DataFrame, comments: DataFrame,
) -> DataFrame:
    """(input, sku_id, create_time) as written, of what the seven inputs leave out of the measures.

    These are the incomplete measure rows, and page records without a time that have none.
    """
    rows = incomplete(product_rows(pages, favors, carts, orders, payments, refunds, comments))
    silent = pages.where(F.col("ts").isNull() & (F.size(_seen()) == 0))
    return rows.select(
        "input", F.col("raw_sku_id").alias("sku_id"), F.col("raw_time").alias("create_time")
    ).unionByName(silent.select(
        F.lit("page").alias("input"), F.col("page.item").alias("sku_id"),
        F.col("ts").cast("string").alias("create_time"),
    ))


def _usable(rows: DataFrame) -> Column:
    usable = F.col("ts").isNotNull()
    return usable & F.col("sku_id").isNotNull() if "sku_id" in rows.columns else usable


# An amount has up to 14 digits before the point and 2 behind it. Its cents are summed in two parts of
# whole numbers, the bits above and the bits below, which cannot overflow below a thousand million rows;
# a sum of long decimals works on objects.
_PARTS, _BITS = ("_high", "_low"), 30


def _two_parts(name: str) -> list[Column]:
    cents = (F.col(name).cast(schemas.MONEY) * F.lit(100)).cast("long")
    low = cents.bitwiseAND(F.lit((1 << _BITS) - 1))
    return [part.alias(name + end) for part, end in zip((F.shiftright(cents, _BITS), low), _PARTS)]


def _one_amount(name: str) -> Column:
    high, low = [F.col(name + end) for end in _PARTS]
    small = high.between(-(1 << _BITS), 1 << _BITS) & (low < (1 << 2 * _BITS))
    exact = high.cast("decimal(20,0)") * F.lit(1 << _BITS).cast("decimal(10,0)") + low
    cents = F.when(small, (F.shiftleft(high, _BITS) + low).cast("decimal(20,0)")).otherwise(exact.cast("decimal(34,0)"))
    return (cents * F.lit(Decimal("0.01"))).cast(schemas.MONEY_SUM).alias(name)


def product_sums(
    rows: DataFrame, width: str = TEN_SECONDS, delay: str = "2 seconds"
) -> DataFrame:
    """Sums and distinct order counts per window and article, without dimensions.

    Amounts are summed as two whole numbers, see ``_two_parts``.
    """
    whole = [name for name in rows.columns if name not in _AMOUNTS]
    timed = rows.select(*whole, *[part for name in _AMOUNTS for part in _two_parts(name)])
    timed = timed.withColumn("rt", millis_time("ts")).withWatermark("rt", delay)
    summed = _COUNTS + [f"{name}{end}" for name in _AMOUNTS for end in _PARTS]
    per_id = timed.groupBy(F.window("rt", width), "sku_id", "id_kind", "id").agg(
        *[F.sum(name).alias(name) for name in summed], F.min("ts").alias("ts")
    )

    def ids(kind: str) -> Column:
        counted = (F.col("id_kind") == kind) & F.col("id").isNotNull()
        return F.sum(F.when(counted, 1).otherwise(0))

    sums = per_id.groupBy("window", "sku_id").agg(
        *[F.sum(name).alias(name) for name in summed],
        ids(ORDERED).alias("order_ct"), ids(PAID).alias("paid_order_ct"),
        ids(REFUNDED).alias("refund_order_ct"), F.min("ts").alias("ts"),
    )
    counted = [name for name in sums.columns if name not in summed and name != "window"]
    return sums.select(
        *_COUNTS, *[_one_amount(name) for name in _AMOUNTS], *counted, *_bounds()
    )


def product_stats(
    rows: DataFrame, snowflake: DataFrame, width: str = TEN_SECONDS, delay: str = "2 seconds"
) -> DataFrame:
    """Article statistics; the lookup runs on the aggregated rows, not on the input."""
    names = ["sku_name", "sku_price", "spu_id", "spu_name", "tm_id", "tm_name",
             "category3_id", "category3_name"]
    key = F.col("id").try_cast("long")
    side = snowflake.where(key.isNotNull()).select(key.alias("_key"), *names)
    sums = product_sums(rows, width, delay)
    joined = sums.join(side, F.col("sku_id") == F.col("_key"), "left")
    return joined.select(*schemas.PRODUCT_STATS_COLUMNS)


_PROVINCE = ["province_id", "province_name", "province_area_code",
             "province_iso_code", "province_3166_2_code"]


def _now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def province_stats(
    wide: DataFrame, width: str = TEN_SECONDS, delay: str = "2 seconds",
    provinces: DataFrame | None = None,
) -> DataFrame:
    """Order amount and distinct orders per window and province.

    Rows that carry the province columns are grouped by them. Rows with the id alone are
    grouped by it, and ``provinces`` is looked up once per result row.
    """
    keys = _PROVINCE if provinces is None else ["province_id"]
    timed = wide.withColumn("rt", parse_time("create_time")).withWatermark("rt", delay)
    per_order = timed.groupBy(F.window("rt", width), *keys, "order_id").agg(
        F.sum("split_total_amount").alias("amount")
    )
    sums = per_order.groupBy("window", *keys).agg(
        F.count("order_id").alias("order_count"),
        F.sum("amount").cast(schemas.MONEY_SUM).alias("order_amount"),
    )
    if provinces is not None:
        sums = add_province(sums, provinces)
    return sums.select("*", *_bounds(), _now_millis().alias("ts")).select(
        *schemas.PROVINCE_STATS_COLUMNS
    )


def search_rows(pages: DataFrame) -> DataFrame:
    """Searched text with its time; works on a page struct and on a page map."""
    page = F.col("page")
    hit = (page["last_page_id"] == "search") & page["item"].isNotNull()
    return pages.where(hit).select(page["item"].alias("key_word"), "ts")


def keyword_stats(
    searches: DataFrame, width: str = TEN_SECONDS, delay: str = "2 seconds",
    source: str = "SEARCH", text: str = "key_word", words: DataFrame | None = None,
) -> DataFrame:
    """Token counts per window."""
    timed = searches.withColumn("rt", seconds_time("ts")).withWatermark("rt", delay)
    tokens = keyword_rows(timed.select(text, "rt"), text, words=words)
    counts = tokens.groupBy(F.window("rt", width), "keyword").agg(F.count("*").alias("ct"))
    return counts.select(
        "*", *_bounds(), F.lit(source).alias("source"), _now_millis().alias("ts")
    ).select(*schemas.KEYWORD_STATS_COLUMNS)
