"""Interval joins of two streams. State is dropped by the watermarks and the bounds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions.times import millis_time
from tidemart.operators import joins as batch_joins
from tidemart.operators.joins import LEFT, RIGHT, prefixed
from tidemart.sinks.tables import BatchWriter


def interval_join(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], times: tuple[str, str],
    lower: int, upper: int, how: str = "inner", delays: tuple[str, str] = ("0 seconds", "0 seconds"),
) -> DataFrame:
    """Streaming twin of the batch interval join: the same columns and bounds.

    Outer forms give an unmatched row once the watermark shows that no partner can come;
    it is never taken back. The result is a stream, and its state is asked row by row; for large
    topics whose pairs go to a table ``interval_joining`` costs a fraction of it.
    """
    a = prefixed(left, LEFT).withColumn("_lt", millis_time(LEFT + times[0]))
    b = prefixed(right, RIGHT).withColumn("_rt", millis_time(RIGHT + times[1]))
    columns = [name for name in a.columns + b.columns if name not in ("_lt", "_rt")]
    a, b = a.withWatermark("_lt", delays[0]), b.withWatermark("_rt", delays[1])
    match = F.expr(
        f"_rt >= _lt + interval {lower} milliseconds and "
        f"_rt <= _lt + interval {upper} milliseconds"
    )
    for x, y in on.items():
        match = match & (F.col(LEFT + x) == F.col(RIGHT + y))
    kind = {"inner": "inner", "left": "leftOuter", "right": "rightOuter", "full": "fullOuter"}[how]
    return a.join(b, match, kind).select(*columns)


def ttl_join(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], times: tuple[str, str],
    ttl: int, how: str = "inner", delays: tuple[str, str] = ("0 seconds", "0 seconds"),
) -> DataFrame:
    """Join of two streams whose rows expire ``ttl`` milliseconds after their time."""
    return interval_join(left, right, on, times, -ttl, ttl, how, delays)


_SIDE, _NEW = "_side", "_new"
_LATEST = "left long, right long"


def both_topics(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two streams as one, for ``interval_joining``: the left columns under ``l_``, the right ones under ``r_``."""
    a = prefixed(left, LEFT).withColumn(_SIDE, F.lit(0))
    return a.unionByName(prefixed(right, RIGHT).withColumn(_SIDE, F.lit(1)), allowMissingColumns=True)


def interval_joining(
    on: Mapping[str, str], times: tuple[str, str], lower: int, upper: int, kept: str, write: BatchWriter,
    how: str = "inner", delays: tuple[int, int] = (0, 0), copy: str = "right",
) -> BatchWriter:
    """Writer that joins the micro-batches of ``both_topics`` and hands on the rows that each completes.

    These are the rows of ``interval_join``, for streams that end in a table. Only rows that can still meet
    a partner are kept, as a table under ``kept``, and a micro-batch joins its own rows and these as the batch join
    does, by sorting, so no store is asked for every row. A row behind the watermark, the lesser of both sides'
    latest times less their ``delays`` (milliseconds), is late and dropped. Outer forms give a row without
    a partner once none can come.

    A micro-batch reads what the one before it kept and writes beside it, so a repeated one sees what
    it saw and replaces what it wrote.
    """
    shown = {"inner": (False, False), "left": (True, False), "right": (False, True), "full": (True, True)}[how]
    # A row meets no new row once the watermark is past it by this much. If it may be what keeps a row of
    # the other side from being shown alone, it stays until that one is over.
    reach = (-upper, lower)
    stays = [min(reach[n], lower - upper) if shown[1 - n] else reach[n] for n in (0, 1)]
    # A row has a time on its own side alone.
    at = (F.col(LEFT + times[0]), F.col(RIGHT + times[1]))

    def joined(a: DataFrame, b: DataFrame, kind: str = "inner") -> DataFrame:
        sides = []
        for n, (rows, prefix) in enumerate([(a, LEFT), (b, RIGHT)]):
            names = [name for name in rows.columns if name.startswith(prefix)]
            plain = [F.col(name).alias(name.removeprefix(prefix)) for name in names]
            sides.append(rows.where(F.col(_SIDE) == n).select(_NEW, *plain))
        return batch_joins.interval_join(*sides, on, times, lower, upper, kind, copy)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own, last = f"{kept}/{batch_id % 2}", f"{kept}/{(batch_id - 1) % 2}"
        before = tuple(spark.read.schema(_LATEST).parquet(f"{last}/latest").first()) if batch_id else (None, None)
        past = _watermark(before, delays)
        timely = at[0].isNotNull() | at[1].isNotNull() if past is None else (at[0] >= past) | (at[1] >= past)
        rows = batch.where(timely).withColumn(_NEW, F.lit(True))
        if batch_id:
            old = spark.read.schema(batch.schema).parquet(f"{last}/rows")
            rows = rows.unionByName(old.withColumn(_NEW, F.lit(False)))
        found = batch.agg(*[F.max(time) for time in at]).first()
        latest = [max((x for x in pair if x is not None), default=None) for pair in zip(before, found)]
        mark = _watermark(latest, delays)

        result = joined(rows, rows).where(F.col(LEFT + _NEW) | F.col(RIGHT + _NEW))
        if mark is not None:
            over = rows.where((at[0] < mark + reach[0]) | (at[1] < mark + reach[1]))
            if past is not None:
                over = over.where(F.col(_NEW) | (at[0] >= past + reach[0]) | (at[1] >= past + reach[1]))
            if shown[0]:
                result = result.unionByName(joined(over, rows, "left").where(F.col(RIGHT + _NEW).isNull()))
            if shown[1]:
                result = result.unionByName(joined(rows, over, "right").where(F.col(LEFT + _NEW).isNull()))
            rows = rows.where((at[0] >= mark + stays[0]) | (at[1] >= mark + stays[1]))
        write(result.drop(LEFT + _NEW, RIGHT + _NEW), batch_id)
        rows.drop(_NEW).write.mode("overwrite").parquet(f"{own}/rows")
        row = spark.range(0, 1, 1, 1).select(*[F.lit(x).cast("long") for x in latest]).toDF("left", "right")
        row.write.mode("overwrite").parquet(f"{own}/latest")

    return run


def _watermark(latest: Sequence[int | None], delays: tuple[int, int]) -> int | None:
    """The time behind which no row counts; none before both sides have come."""
    return None if None in latest else min(time - delay for time, delay in zip(latest, delays))
