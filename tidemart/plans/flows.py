"""The layered flows in batch form, from bound inputs to statistics."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemart import bind, schemas
from tidemart.operators import joins, logs, orders, stats, visits
from tidemart.plans.layers import layer
from tidemart.plans.periods import DAYS, PeriodStatistics
from tidemart.streaming.run import stored

HOUR, DAY = 3_600_000, 86_400_000


@dataclass(frozen=True)
class Durations:
    """Time bounds in milliseconds and window widths; the defaults are the live ones."""

    bounce_timeout: int = 10_000
    order_bound: int = 5 * orders.SECOND
    payment_lower: int = -15 * orders.MINUTE
    payment_upper: int = 5 * orders.SECOND
    visitor_window: str = stats.TEN_SECONDS
    product_window: str = stats.TEN_SECONDS
    # Leading characters of a window start that name a partition of stored statistics.
    period_width: int = 10


# The test tables are sparse in time, so they are read with longer bounds.
SPARSE = Durations(
    bounce_timeout=6 * HOUR, order_bound=120 * DAY,
    visitor_window="1 hour", product_window="1 day", period_width=7,
)


@dataclass(frozen=True)
class VisitFlow:
    pages: DataFrame
    visits: DataFrame
    bounces: DataFrame

    def rows(self, literal: bool = False) -> DataFrame:
        return stats.visitor_rows(self.pages, self.visits, self.bounces, literal)


def visit_flow(pages: DataFrame, durations: Durations = Durations()) -> VisitFlow:
    """Unique visits and bounces of a page log whose new flag is repaired."""
    return VisitFlow(
        pages, visits.unique_visits(pages),
        visits.bounce_details(pages, durations.bounce_timeout),
    )


def repaired_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page log with its new flag repaired, stored as a layer of its own.

    Three operators read it. Were it not stored, each would parse the log and repair it
    again; stored, each scans only the columns it needs.
    """
    pages = logs.repair_new_flag(bind.page_log(spark, sf_dir))
    return spark.read.schema(pages.schema).parquet(stored(spark, pages, "page-log"))


def snowflake(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> DataFrame:
    """The article dimension with all its names, as a layer."""
    return layer(spark, sf_dir, "dim-sku", lambda: joins.sku_snowflake(
        bind.dim_sku(spark, sf_dir), bind.dim_spu(spark, sf_dir),
        bind.dim_trademark(spark, sf_dir), bind.dim_category3(spark, sf_dir),
    ), rebuild=rebuild, tables=("part",))


def joined_orders(spark: SparkSession, sf_dir: str, durations: Durations = SPARSE) -> DataFrame:
    return orders.join_orders(
        orders.good_times(orders.parse_orders(bind.order_info(spark, sf_dir))),
        orders.good_times(orders.parse_created(bind.order_detail(spark, sf_dir))),
        -durations.order_bound, durations.order_bound,
    )


def wide_orders(spark: SparkSession, sf_dir: str, durations: Durations = SPARSE) -> DataFrame:
    return orders.widen_orders(
        joined_orders(spark, sf_dir, durations),
        bind.dim_user(spark, sf_dir), bind.dim_province(spark, sf_dir),
        snowflake(spark, sf_dir), bind.AS_OF,
    )


def wide_payments(spark: SparkSession, sf_dir: str, durations: Durations = SPARSE) -> DataFrame:
    return orders.join_payments(
        orders.good_times(orders.parse_created(bind.payment_info(spark, sf_dir))),
        wide_orders(spark, sf_dir, durations),
        durations.payment_lower, durations.payment_upper,
    )


#: The fields of a joined order that measure rows and the payment join read.
_MEASURED = ("order_id", "sku_id", "sku_num", "split_total_amount", "create_time")


def product_inputs(
    spark: SparkSession, sf_dir: str, durations: Durations = SPARSE
) -> dict[str, DataFrame]:
    """The seven inputs of the product statistics.

    The joined orders are stored first, as the layer between the jobs, since both the
    order rows and the payment join read them. They carry the fields that these two read, and
    no dimensions: the statistics look those up after aggregating. So the join of orders and
    details moves a few numbers a row.
    """
    joined = joined_orders(spark, sf_dir, durations)
    kinds = {field.name: field.dataType for field in joined.schema}
    wide = joined.select(*[
        F.col(name) if name in _MEASURED else F.lit(None).cast(kinds.get(name, "string")).alias(name)
        for name in schemas.ORDER_WIDE_COLUMNS
    ])
    layer = spark.read.schema(wide.schema).parquet(stored(spark, wide, "order-wide"))
    paid = orders.join_payments(
        orders.good_times(orders.parse_created(bind.payment_info(spark, sf_dir))), layer,
        durations.payment_lower, durations.payment_upper,
    )
    return {
        "pages": bind.page_log(spark, sf_dir), "favors": bind.favor_info(spark, sf_dir),
        "carts": bind.cart_info(spark, sf_dir), "orders": layer, "payments": paid,
        "refunds": bind.refund_info(spark, sf_dir), "comments": bind.comment_info(spark, sf_dir),
    }


def product_measures(spark: SparkSession, sf_dir: str, durations: Durations = SPARSE) -> DataFrame:
    """Measure rows of all seven inputs that have a time and a readable article."""
    return stats.complete(stats.product_rows(**product_inputs(spark, sf_dir, durations)))


def dirty_times(inputs: dict[str, DataFrame], key: str) -> DataFrame:
    """(input, key, create_time): rows of the inputs whose time cannot be read.

    Together with the rows that the flow goes on with they are all that came.
    """
    found = [
        orders.bad_times(orders.parse_created(rows)).select(
            F.lit(name).alias("input"), F.col(key).cast("string").alias(key), "create_time")
        for name, rows in inputs.items()
    ]
    return reduce(DataFrame.unionByName, found)


def product_dirty(spark: SparkSession, sf_dir: str, durations: Durations = SPARSE) -> DataFrame:
    """What the measures leave behind of all seven inputs."""
    return stats.product_dirty(**product_inputs(spark, sf_dir, durations))


def product_stats(spark: SparkSession, sf_dir: str, durations: Durations = SPARSE) -> DataFrame:
    return stats.product_stats(
        product_measures(spark, sf_dir, durations), snowflake(spark, sf_dir),
        durations.product_window,
    )


def visitor_stats(
    spark: SparkSession, sf_dir: str, durations: Durations = SPARSE, literal: bool = False
) -> DataFrame:
    flow = visit_flow(repaired_pages(spark, sf_dir), durations)
    return stats.visitor_stats(flow.rows(literal), durations.visitor_window)


def province_stats(spark: SparkSession, sf_dir: str, durations: Durations = SPARSE) -> DataFrame:
    return stats.province_stats(
        joined_orders(spark, sf_dir, durations), durations.product_window,
        provinces=bind.dim_province(spark, sf_dir),
    )


def keyword_stats(spark: SparkSession, sf_dir: str, durations: Durations = SPARSE) -> DataFrame:
    searches = stats.search_rows(bind.page_log(spark, sf_dir))
    return stats.keyword_stats(searches, durations.visitor_window)


STATISTICS = {
    "product": product_stats, "visitor": visitor_stats, "province": province_stats,
    "keyword": keyword_stats,
}
#: The tables that each of the statistics is computed from.
_ORDERS = ("orders", "lineitem", "customer")
TABLES = {
    "product": ("events", "part", *_ORDERS), "visitor": ("events",), "keyword": ("events",),
    "province": ("nation", "region", *_ORDERS),
}


def statistics(
    spark: SparkSession, sf_dir: str, name: str, durations: Durations = SPARSE, rebuild: bool = False
) -> DataFrame:
    """A statistics table as the jobs leave it and the reports read it, stored by period."""
    return layer(
        spark, sf_dir, f"{name}-stats", lambda: STATISTICS[name](spark, sf_dir, durations),
        durations.period_width, rebuild, TABLES[name],
    )


def product_by_period(
    spark: SparkSession, sf_dir: str, path: str, durations: Durations = SPARSE, schema: StructType | None = None
) -> PeriodStatistics:
    """Product statistics kept up from measure rows, which stand for themselves.

    ``schema`` is that of the measure rows; without it they are made to learn it, which stores the joined orders.
    """
    schema = schema or product_measures(spark, sf_dir, durations).schema
    return PeriodStatistics(
        spark, path, {"rows": schema}, {"rows": "ts"},
        lambda read: stats.product_stats(read["rows"], snowflake(spark, sf_dir), durations.product_window),
        durations.period_width,
    )


def visitor_by_period(spark: SparkSession, pages: DataFrame, path: str, durations: Durations = SPARSE) -> PeriodStatistics:
    """Visitor statistics kept up from repaired pages; a page may decide a bounce one timeout before it."""
    return PeriodStatistics(
        spark, path, {"pages": pages.schema}, {"pages": "ts"},
        lambda read: stats.visitor_stats(
            visit_flow(read["pages"], durations).rows(), durations.visitor_window),
        DAYS, durations.bounce_timeout,
    )


def build_statistics(spark: SparkSession, sf_dir: str, durations: Durations = SPARSE) -> None:
    """Write all statistics tables anew, before reports are asked for."""
    for name in STATISTICS:
        statistics(spark, sf_dir, name, durations, rebuild=True)
