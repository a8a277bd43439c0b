"""Orders, details and payments, and the wide records made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart import schemas
from tidemart.functions.once import once
from tidemart.functions.times import age_years, parse_millis
from tidemart.operators.joins import LEFT, RIGHT, enrich, interval_join

SECOND, MINUTE = 1_000, 60_000


def parse_orders(orders: DataFrame) -> DataFrame:
    """Add date, two-digit hour and epoch milliseconds of the creation time."""
    halves = F.split("create_time", " ")
    return parse_created(orders).select(
        *orders.columns,
        F.get(halves, F.lit(0)).alias("create_date"),
        F.get(F.split(F.get(halves, F.lit(1)), ":"), F.lit(0)).alias("create_hour"),
        "create_ts",
    )


def parse_created(df: DataFrame) -> DataFrame:
    """Add the epoch milliseconds of the creation time (details and payments)."""
    return df.select("*", once(parse_millis("create_time")).alias("create_ts"))


def bad_times(parsed: DataFrame) -> DataFrame:
    """Rows whose time could not be read; they join nothing and belong to a dirty table."""
    return parsed.where(F.col("create_ts").isNull())


def good_times(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("create_ts").isNotNull())


# The order's id and unused fields are set apart; its name of the article is the detail's.
_UNFILLED = ("expire_time", "operate_time")
_FROM_ORDER = [
    name for name in (*schemas.ORDER_INFO.fieldNames(), "create_date", "create_hour")
    if name != "id" and name not in _UNFILLED
]
_FROM_DETAIL = [
    name for name in schemas.ORDER_DETAIL.fieldNames() if name not in ("id", "order_id", "create_time")
]


def merge_order_detail(pairs: DataFrame) -> DataFrame:
    """One wide row per order and detail pair, before any dimension is added.

    ``split_feight_fee``, ``expire_time`` and ``operate_time`` exist and are never filled.
    """
    return pairs.select(
        F.col(LEFT + "id").alias("order_id"),
        F.col(RIGHT + "id").alias("detail_id"),
        *[F.col(LEFT + name).alias(name) for name in _FROM_ORDER],
        *[F.col(RIGHT + name).alias(name) for name in _FROM_DETAIL],
        F.lit(None).cast(schemas.MONEY).alias("split_feight_fee"),
        F.lit(None).cast("string").alias("expire_time"),
        F.lit(None).cast("string").alias("operate_time"),
    )


def join_orders(
    orders: DataFrame, details: DataFrame, lower: int = -5 * SECOND, upper: int = 5 * SECOND
) -> DataFrame:
    """Orders with their details, created within the bounds of each other."""
    pairs = interval_join(
        orders, details, {"id": "order_id"}, ("create_ts", "create_ts"), lower, upper,
        copy="left",
    )
    return merge_order_detail(pairs)


def add_user(df: DataFrame, users: DataFrame, as_of: Column | str) -> DataFrame:
    as_of = F.lit(as_of) if isinstance(as_of, str) else as_of
    return enrich(
        df, users, "user_id",
        {"user_gender": "gender", "user_age": age_years("birthday", as_of)},
    )


def add_province(df: DataFrame, provinces: DataFrame) -> DataFrame:
    return enrich(
        df, provinces, "province_id",
        {
            "province_name": "name", "province_area_code": "area_code",
            "province_iso_code": "iso_code", "province_3166_2_code": "iso_3166_2",
        },
    )


def add_sku(df: DataFrame, snowflake: DataFrame) -> DataFrame:
    """Article name, and the ids and names behind the article, in one lookup."""
    names = [
        "sku_name", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name",
    ]
    return enrich(df, snowflake, "sku_id", {name: name for name in names})


def widen_orders(
    joined: DataFrame, users: DataFrame, provinces: DataFrame, snowflake: DataFrame,
    as_of: Column | str,
) -> DataFrame:
    wide = add_sku(add_province(add_user(joined, users, as_of), provinces), snowflake)
    return wide.select(*schemas.ORDER_WIDE_COLUMNS)


def join_payments(
    payments: DataFrame, wide: DataFrame, lower: int = -15 * MINUTE, upper: int = 5 * SECOND
) -> DataFrame:
    """Payments with the wide order rows created in the bounds around them.

    Where both sides have a field, the payment's value stands.
    """
    pairs = interval_join(
        payments, parse_created(wide), {"order_id": "order_id"},
        ("create_ts", "create_ts"), lower, upper, copy="left",
    )
    return merge_payment(pairs)


def merge_payment(pairs: DataFrame) -> DataFrame:
    renamed = {
        "payment_id": LEFT + "id", "payment_create_time": LEFT + "create_time",
        "order_create_time": RIGHT + "create_time",
    }

    def source(name: str) -> str:
        if name in renamed:
            return renamed[name]
        return (LEFT if name in schemas.PAYMENT_INFO.fieldNames() else RIGHT) + name

    return pairs.select(*[F.col(source(n)).alias(n) for n in schemas.PAYMENT_WIDE_COLUMNS])


#: The fields that two wide rows of an order detail merge, and those of them that are taken from the first alone.
MERGED_FIELDS = [
    "order_status", "create_time", "create_date", "coupon_reduce_amount", "activity_reduce_amount",
    "original_total_amount", "feight_fee", "total_amount", "user_id", "sku_id", "sku_name", "order_price", "sku_num",
    "split_activity_amount", "split_coupon_amount", "split_total_amount",
]
OWN_FIELDS = ("split_activity_amount", "split_coupon_amount", "split_total_amount")


def first_non_null(
    left: DataFrame, right: DataFrame, on: list[str], own_only: tuple[str, ...] = ()
) -> DataFrame:
    """Rows of ``left`` with their gaps filled from the ``right`` row of the same key.

    Columns in ``own_only`` are taken from ``left`` alone.
    """
    other = right.select(
        *on, *[F.col(n).alias(f"_other_{n}") for n in left.columns
               if n in right.columns and n not in on and n not in own_only],
    )
    joined = left.join(other, on, "left")
    return joined.select(
        *[
            F.coalesce(F.col(n), F.col(f"_other_{n}")).alias(n)
            if f"_other_{n}" in joined.columns else F.col(n)
            for n in left.columns
        ]
    )
