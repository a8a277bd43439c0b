"""Run a stream over everything available, with a checkpoint in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.session import fresh_dir


def drain_to_files(
    df: DataFrame, path: str, checkpoint: str, mode: str = "append",
    partition_by: tuple[str, ...] = (),
) -> None:
    writer = df.writeStream.format("parquet").outputMode(mode).option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start().awaitTermination()


def drain_to_batches(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> None:
    query = df.writeStream.foreachBatch(write).outputMode(mode)
    query = query.option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()


def drained(spark: SparkSession, df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """The whole output of a stream as a table, read by the caller's session."""
    base = fresh_dir(spark, name)
    drain_to_files(df, f"{base}/out", f"{base}/checkpoint", mode)
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def drained_in_order(
    spark: SparkSession, own: SparkSession, frames: dict[str, DataFrame], times: dict[str, str],
    plan: Callable[[dict[str, DataFrame]], DataFrame], name: str, parts: int = 2,
) -> DataFrame:
    """The output of a plan over several topics that fill up in order of time.

    The common span of the times (epoch milliseconds) is cut into ``parts``. The rows of a
    part come to all topics, then the query runs to their end and stops; the next part goes on
    from its checkpoint. So state is carried from run to run, and no row is late.
    """
    base = fresh_dir(spark, name)
    schema = None
    for folders in in_order_of_time(spark, frames, times, f"{base}/in", parts):
        streams = {n: own.readStream.schema(frames[n].schema).parquet(folder) for n, folder in folders.items()}
        result = plan(streams)
        schema = result.schema
        drain_to_files(result, f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(schema).parquet(f"{base}/out")


def in_order_of_time(
    spark: SparkSession, frames: dict[str, DataFrame], times: dict[str, str], base: str, parts: int = 2,
    written: bool = False,
) -> Iterator[dict[str, str]]:
    """Folders of topics, given out once each further part of the common span of time has come.

    The frames are stored first, so that each is evaluated once; not so what is ``written`` already.
    """
    kept = frames if written else {
        n: spark.read.schema(f.schema).parquet(stored(spark, f, n)) for n, f in frames.items()}
    ends = [
        frame.agg(F.min(times[n]).alias("lo"), F.max(times[n]).alias("hi")).first() for n, frame in kept.items()
    ]
    low = min((e.lo for e in ends if e.lo is not None), default=0)
    high = max((e.hi for e in ends if e.hi is not None), default=0)
    width = (high - low) // parts + 1
    for part in range(parts):
        for n, frame in kept.items():
            mine = F.coalesce(F.floor((F.col(times[n]) - low) / width), F.lit(0)) == part
            frame.where(mine).write.mode("append").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{base}/{n}")
        yield {n: f"{base}/{n}" for n in kept}


#: Rows of a file of a topic at most, so that a task that reads one has a bounded share.
ROWS_PER_FILE = 500_000

#: Rows of a topic that one state partition may be given over the whole run.
ROWS_PER_STATE = 1_000_000


def state_partitions(spark: SparkSession, rows: int) -> int:
    """State partitions for so many rows, one per core at least, so that a task's memory does not grow with them."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_STATE))


def stored(
    spark: SparkSession, df: DataFrame, name: str, format: str = "parquet", partition_by: tuple[str, ...] = ()
) -> str:
    """Write a table to a fresh folder, which then serves as the files of a topic."""
    path = fresh_dir(spark, name)
    writer = df.write.format(format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path
