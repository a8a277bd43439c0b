"""Dashboard results over the statistics tables, one function each.

``day`` is ``yyyyMMdd``; without one, the day of the clock is meant: ``now``, or the current
date. ``last`` makes the period longer than a day. The period is a range on the window-start
text and, for stored statistics, on their partitions, so other partitions are not read.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart import schemas
from tidemart.functions.codes import KEYWORD_WEIGHT
from tidemart.functions.rates import bounce_rate, pages_per_visit, seconds_per_visit
from tidemart.functions.times import parse_time
from tidemart.plans.layers import PERIOD


def _period(
    stats: DataFrame, day: str | None, last: str | None, now: Column | str | None = None
) -> DataFrame:
    if day is None:
        clock = F.current_date() if now is None else F.to_date(F.lit(now) if isinstance(now, str) else now)
        first = final = F.date_format(clock, "yyyy-MM-dd")
    else:
        first, final = [
            F.lit(datetime.strptime(d, "%Y%m%d").strftime("%Y-%m-%d")) for d in (day, last or day)
        ]
    found = stats.where(F.col("stt").between(first, F.concat(final, F.lit(" 23:59:59"))))
    if PERIOD in stats.columns:
        # A day's text begins with the name of its partition, be it of days or months.
        period = F.col(PERIOD)
        width = F.length(period)
        found = found.where(
            (period >= first.substr(F.lit(1), width)) & (period <= final.substr(F.lit(1), width))
        )
    return found


def gross_sales(product_stats: DataFrame, day: str | None = None, last: str | None = None, now=None) -> DataFrame:
    total = F.coalesce(F.sum("order_amount"), F.lit(0)).cast(schemas.MONEY_SUM)
    return _period(product_stats, day, last, now).agg(total.alias("order_amount"))


def _ranked(
    product_stats: DataFrame, keys: list[str], day: str | None, last: str | None,
    limit: int, now: Column | str | None, orders: bool = False,
) -> DataFrame:
    sums = [F.sum("order_amount").cast(schemas.MONEY_SUM).alias("order_amount")]
    if orders:
        sums.append(F.sum("order_ct").alias("order_ct"))
    totals = _period(product_stats, day, last, now).groupBy(*keys).agg(*sums)
    return (
        totals.where("order_amount > 0")
        .orderBy(F.col("order_amount").desc(), *keys)
        .limit(limit)
    )


def by_trademark(product_stats, day=None, last=None, limit: int = 10, now=None) -> DataFrame:
    return _ranked(product_stats, ["tm_id", "tm_name"], day, last, limit, now)


def by_category3(product_stats, day=None, last=None, limit: int = 10, now=None) -> DataFrame:
    return _ranked(product_stats, ["category3_id", "category3_name"], day, last, limit, now)


def by_spu(product_stats, day=None, last=None, limit: int = 10, now=None) -> DataFrame:
    return _ranked(product_stats, ["spu_id", "spu_name"], day, last, limit, now, orders=True)


def trademark_series(product_stats, day=None, last=None, limit: int = 10, now=None) -> DataFrame:
    """The trademark ranking as two parallel arrays; ``limit`` bounds their length."""
    top = by_trademark(product_stats, day, last, limit, now)
    ranked = F.array_sort(
        F.collect_list(F.struct((-F.col("order_amount")).alias("k"), "tm_id", "tm_name", "order_amount"))
    )
    return top.agg(ranked.alias("r")).select(
        F.col("r.tm_name").alias("categories"), F.col("r.order_amount").alias("data")
    )


def by_province(province_stats: DataFrame, day=None, last=None, now=None) -> DataFrame:
    totals = _period(province_stats, day, last, now).groupBy("province_id", "province_name").agg(
        F.sum("order_amount").cast(schemas.MONEY_SUM).alias("order_amount")
    )
    return totals.select("province_name", "order_amount")


_SUMS = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]


def by_new_flag(visitor_stats: DataFrame, day=None, last=None, now=None) -> DataFrame:
    return _period(visitor_stats, day, last, now).groupBy("is_new").agg(
        *[F.sum(name).alias(name) for name in _SUMS]
    )


# The row labels of the new-versus-returning table.
RATE_ROWS = ["visitors", "pages", "bounce_rate", "seconds_per_visit", "pages_per_visit"]


def visitor_rates(visitor_stats: DataFrame, day=None, last=None, now=None) -> DataFrame:
    """Five rows, new and returning visitors side by side; a missing side is zero."""
    sides = F.when(F.col("is_new") == "1", "new").otherwise("old")
    sums = (
        _period(visitor_stats, day, last, now).groupBy(sides.alias("side"))
        .agg(*[F.sum(name).alias(name) for name in _SUMS])
    )
    uv, pv, sv, uj, dur = [F.col(name) for name in _SUMS]
    form = "decimal(20,2)"
    values = [
        uv.cast(form), pv.cast(form), bounce_rate(uj, sv, uv),
        seconds_per_visit(dur, sv, uv), pages_per_visit(pv, sv, uv),
    ]
    pairs = F.array(*[
        F.struct(F.lit(n).alias("row"), F.lit(label).alias("type"), value.alias("value"))
        for n, (label, value) in enumerate(zip(RATE_ROWS, values))
    ])
    cells = sums.select("side", F.explode(pairs).alias("c")).select("side", "c.*")
    spark = visitor_stats.sparkSession
    labels = spark.createDataFrame(list(enumerate(RATE_ROWS)), "row int, type string")
    wide = cells.groupBy("row").pivot("side", ["new", "old"]).agg(F.first("value"))
    zero = F.lit(0).cast(form)
    return labels.join(wide, "row", "left").orderBy("row").select(
        "type", F.coalesce("new", zero).alias("new"), F.coalesce("old", zero).alias("old")
    )


def by_hour(visitor_stats: DataFrame, day=None, last=None, now=None) -> DataFrame:
    newcomers = F.sum(F.when(F.col("is_new") == "1", F.col("uv_ct")).otherwise(0))
    return (
        _period(visitor_stats, day, last, now)
        .groupBy(F.hour(parse_time("stt")).alias("hr"))
        .agg(
            newcomers.alias("new_uv"), F.sum("uv_ct").alias("uv_ct"),
            F.sum("pv_ct").alias("pv_ct"), F.sum("uj_ct").alias("uj_ct"),
        )
        .orderBy("hr")
    )


def hours_filled(visitor_stats: DataFrame, day=None, last=None, now=None) -> DataFrame:
    """All 24 hours with two-digit labels; hours without visits hold zeros."""
    spark: SparkSession = visitor_stats.sparkSession
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    found = by_hour(visitor_stats, day, last, now)
    joined = hours.join(found, F.col("hour") == F.col("hr"), "left")
    return joined.orderBy("hour").select(
        F.lpad(F.col("hour").cast("string"), 2, "0").alias("hr"),
        *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n)
          for n in ("uv_ct", "pv_ct", "new_uv")],
    )


def keyword_scores(keyword_stats: DataFrame, day=None, last=None, limit: int = 20, now=None) -> DataFrame:
    """Counts weighted by their source, ranked by the plain count."""
    source, weight = F.upper("source"), F.lit(0)
    for name, value in KEYWORD_WEIGHT.items():
        weight = F.when(source == name, value).otherwise(weight)
    totals = _period(keyword_stats, day, last, now).groupBy("keyword").agg(
        F.sum(F.col("ct") * weight).alias("score"), F.sum("ct").alias("plain")
    )
    return totals.orderBy(F.col("plain").desc(), "keyword").limit(limit).select(
        F.col("keyword").alias("name"), F.col("score").alias("value")
    )
