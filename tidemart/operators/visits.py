"""Visits: the first visit of the day, and bounces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.functions.times import millis_date, slice_of

MATCHED, TIMED_OUT = "matched", "timeout"

# Rows at the head of a slice are copied to the slice before; with slices this many
# times longer than the timeout, one row in thirty-two is.
SLICES_PER_TIMEOUT = 32


def is_entry() -> Column:
    """A visit begins on a page that no other page led to."""
    return F.col("page.last_page_id").isNull()


def unique_visits(pages: DataFrame, order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """The first entry page of each visitor on each day.

    Spark keeps one row per visitor and day in every map task before the shuffle
    (``WindowGroupLimit``), so a busy visitor does not load one reducer.
    """
    dated = pages.where(is_entry()).withColumn("_day", millis_date("ts"))
    first = Window.partitionBy(F.col("common.mid"), F.col("_day")).orderBy(*order)
    return dated.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "_day")


def look_ahead_slices(time: Column, timeout: int, width: int) -> Column:
    """The slices a record belongs to: its own and, at the head of it, the one before."""
    if width < timeout:
        raise ValueError("a slice must be at least as long as the timeout")
    own = slice_of(time, width)
    at_head = time - own * width < timeout
    return F.when(at_head, F.array(own - 1, own)).otherwise(F.array(own))


def bounce_details(
    pages: DataFrame, timeout: int, order: tuple[str, ...] = ("ts", "event_id"),
    width: int | None = None, kind: str = "bounce_kind",
) -> DataFrame:
    """Entry pages from which the visitor went nowhere.

    An entry bounces when the visitor's next record is another entry less than
    ``timeout`` milliseconds later (``matched``), or when none comes in that time
    (``timeout``). ``order`` begins with the event time.

    Only records less than ``timeout`` away can decide an entry. So time is cut into
    slices, the first ``timeout`` of each slice is copied to the slice before, and the
    look-ahead runs within one visitor and slice: the history of a busy visitor is never
    sorted in one task.
    """
    width = width or SLICES_PER_TIMEOUT * timeout
    time = F.col(order[0])
    own, spots = slice_of(time, width), look_ahead_slices(time, timeout, width)
    decided = is_entry() & (F.col("_slice") == own)
    spread = pages.select("*", F.explode(spots).alias("_slice")).select(
        "_slice", *order, F.col("common.mid").alias("_mid"),
        is_entry().alias("_entry"), decided.alias("_decided"),
        # Other records only stand for their time: their fields need not be shuffled.
        *[F.when(decided, F.col(n)).alias(n) for n in pages.columns if n not in order],
    )
    ahead = Window.partitionBy("_mid", "_slice").orderBy(*order)
    spread = spread.select(
        "*",
        F.lead(time).over(ahead).alias("_next_time"),
        F.lead("_entry").over(ahead).alias("_next_entry"),
    )
    alone = F.col("_next_time").isNull() | (F.col("_next_time") - time >= timeout)
    verdict = F.when(alone, TIMED_OUT).when(F.col("_next_entry"), MATCHED)
    return (
        spread.where("_decided")
        .withColumn(kind, verdict)
        .where(F.col(kind).isNotNull())
        .select(*pages.columns, kind)
    )
