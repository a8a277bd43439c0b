"""Windows of a stream whose rows are handed on together once the watermark has passed their end."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemart.functions.times import millis_time
from tidemart.sinks.tables import BatchWriter

_WINDOW = "_window"
_MARK = "mark long"


def closing(time: str, width: str, delay: int, kept: str, write: BatchWriter) -> BatchWriter:
    """Writer that hands on the rows of the windows that each micro-batch closes.

    A batch statistic over these rows gives what the same statistic gives on a stream in append mode, for streams
    that end in a table: a window closes when the watermark, the latest ``time`` less ``delay`` (both milliseconds)
    and none before 1970, reaches its end, and a row whose window has closed before its micro-batch is late and
    dropped. Spark closes a window one micro-batch later, and may still count rows that come late in that one.
    Only rows of open windows are kept, as a table under ``kept``, so a row that comes and goes
    within a micro-batch is never put into a state store, which writes each to its own disk and to the checkpoint.

    A micro-batch reads what the one before it kept and writes beside it, so a repeated one sees what
    it saw and replaces what it wrote.
    """
    end = F.unix_millis(f"{_WINDOW}.end")

    def windowed(rows: DataFrame) -> DataFrame:
        return rows.withColumn(_WINDOW, F.window(millis_time(time), width))

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own, last = f"{kept}/{batch_id % 2}", f"{kept}/{(batch_id - 1) % 2}"
        past = spark.read.schema(_MARK).parquet(f"{last}/mark").first().mark if batch_id else 0
        latest = batch.agg(F.max(time).alias("latest")).first().latest
        mark = past if latest is None else max(past, latest - delay)
        rows = windowed(batch).where(end > past)
        if batch_id:
            rows = rows.unionByName(windowed(spark.read.schema(batch.schema).parquet(f"{last}/rows")))
        write(rows.where(end <= mark).drop(_WINDOW), batch_id)
        rows.where(end > mark).drop(_WINDOW).write.mode("overwrite").parquet(f"{own}/rows")
        spark.range(0, 1, 1, 1).select(F.lit(mark).cast("long").alias("mark")).write.mode("overwrite").parquet(f"{own}/mark")

    return run
