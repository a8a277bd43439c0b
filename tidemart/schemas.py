"""Record shapes of the topics, facts, rules and statistics tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(16, 2)
MONEY_SUM = T.DecimalType(38, 2)


def struct_of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _L = T.StringType(), T.LongType()

COMMON = struct_of(mid=_S, vc=_S, ch=_S, ar=_S, is_new=_S)
PAGE = struct_of(page_id=_S, last_page_id=_S, item=_S, item_type=_S, during_time=_L)
DISPLAY = struct_of(item=_S, item_type=_S)

# Only the presence of ``start`` matters, so its JSON text is kept as it is.
APP_LOG = struct_of(common=COMMON, page=PAGE, displays=T.ArrayType(DISPLAY), start=_S, ts=_L)
PAGE_LOG = struct_of(common=COMMON, page=PAGE, displays=T.ArrayType(DISPLAY), ts=_L)

TEXT_MAP = T.MapType(_S, _S)

# The change envelope as the capture tool writes it.
RAW_CHANGE = struct_of(
    before=TEXT_MAP, after=TEXT_MAP, source=struct_of(db=_S, table=_S), op=_S, ts_ms=_L
)

RULE = struct_of(
    source_table=_S, operate_type=_S, sink_type=_S, sink_table=_S,
    sink_columns=_S, sink_pk=_S, sink_extend=_S,
)

ORDER_INFO = struct_of(
    id=_L, province_id=_L, order_status=_S, user_id=_L, total_amount=MONEY,
    activity_reduce_amount=MONEY, coupon_reduce_amount=MONEY,
    original_total_amount=MONEY, feight_fee=MONEY,
    expire_time=_S, create_time=_S, operate_time=_S,
)
ORDER_DETAIL = struct_of(
    id=_L, order_id=_L, sku_id=_L, order_price=MONEY, sku_num=_L, sku_name=_S,
    create_time=_S, split_total_amount=MONEY, split_activity_amount=MONEY,
    split_coupon_amount=MONEY,
)
PAYMENT_INFO = struct_of(
    id=_L, order_id=_L, user_id=_L, total_amount=MONEY, subject=_S,
    payment_type=_S, create_time=_S, callback_time=_S,
)

# Column order of the wide records and of the statistics tables.
ORDER_WIDE_COLUMNS = [
    "detail_id", "order_id", "sku_id", "order_price", "sku_num", "sku_name",
    "province_id", "order_status", "user_id", "total_amount",
    "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
    "feight_fee", "split_feight_fee", "split_activity_amount",
    "split_coupon_amount", "split_total_amount", "expire_time", "create_time",
    "operate_time", "create_date", "create_hour", "province_name",
    "province_area_code", "province_iso_code", "province_3166_2_code",
    "user_age", "user_gender", "spu_id", "tm_id", "category3_id", "spu_name",
    "tm_name", "category3_name",
]
PAYMENT_WIDE_COLUMNS = [
    "payment_id", "subject", "payment_type", "payment_create_time",
    "callback_time", "detail_id", "order_id", "sku_id", "order_price", "sku_num",
    "sku_name", "province_id", "order_status", "user_id", "total_amount",
    "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
    "feight_fee", "split_feight_fee", "split_activity_amount",
    "split_coupon_amount", "split_total_amount", "order_create_time",
    "province_name", "province_area_code", "province_iso_code",
    "province_3166_2_code", "user_age", "user_gender", "spu_id", "tm_id",
    "category3_id", "spu_name", "tm_name", "category3_name",
]
VISITOR_STATS_COLUMNS = [
    "stt", "edt", "vc", "ch", "ar", "is_new",
    "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts",
]
PRODUCT_STATS_COLUMNS = [
    "stt", "edt", "sku_id", "sku_name", "sku_price", "spu_id", "spu_name",
    "tm_id", "tm_name", "category3_id", "category3_name", "display_ct",
    "click_ct", "favor_ct", "cart_ct", "order_sku_num", "order_amount",
    "order_ct", "payment_amount", "paid_order_ct", "refund_order_ct",
    "refund_amount", "comment_ct", "good_comment_ct", "ts",
]
PROVINCE_STATS_COLUMNS = [
    "stt", "edt", "province_id", "province_name", "province_area_code",
    "province_iso_code", "province_3166_2_code", "order_amount", "order_count", "ts",
]
KEYWORD_STATS_COLUMNS = ["keyword", "ct", "source", "stt", "edt", "ts"]
