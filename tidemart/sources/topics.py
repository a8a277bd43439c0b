"""Topics: Kafka in service, folders of files elsewhere; the same functions read both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_topic(
    spark: SparkSession, topic: str, *, format: str = "kafka", servers: str | None = None,
    path: str | None = None, schema: StructType | str | None = None,
    starting: str = "latest", stream: bool = True, options: dict[str, str] | None = None,
) -> DataFrame:
    """Messages of a topic.

    Kafka gives ``value`` as text beside topic, partition and offset, and a query resumes
    from its own checkpoint; ``starting`` counts on its first run only. ``text`` gives
    ``value``. ``json`` and ``parquet`` give the columns of ``schema``.
    """
    reader = (spark.readStream if stream else spark.read).format(format)
    reader = reader.options(**(options or {}))
    if format == "kafka":
        reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        # A batch read must not start at the end.
        reader = reader.option("startingOffsets", starting if stream else "earliest")
        return reader.load().selectExpr(
            "topic", "partition", "offset", "cast(value as string) value"
        )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path or topic)


def parsed(messages: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """The messages as columns; only the fields of ``schema`` are read."""
    return messages.select(F.from_json(value, schema).alias("_m")).select("_m.*")


def topic_table(
    messages: DataFrame, view: str, schema: StructType, event_time: Column,
    delay: str = "2 seconds", time_column: str = "rt",
) -> DataFrame:
    """A topic as an SQL table with an event-time column and its watermark."""
    table = parsed(messages, schema).withColumn(time_column, event_time)
    table = table.withWatermark(time_column, delay)
    table.createOrReplaceTempView(view)
    return table


def split_lines(lines: DataFrame, value: str = "value", sep: str = ",") -> DataFrame:
    """Sensor lines ``id,ts,vc`` as typed columns."""
    fields = F.split(F.col(value), sep)
    return lines.select(
        F.get(fields, F.lit(0)).alias("id"),
        F.get(fields, F.lit(1)).try_cast("long").alias("ts"),
        F.get(fields, F.lit(2)).try_cast("double").alias("vc"),
    )


def log_files(spark: SparkSession, path: str, stream: bool = True) -> DataFrame:
    """App-log lines of daily files; the day is read from the name of the file or folder."""
    reader = spark.readStream if stream else spark.read
    day = F.regexp_extract(F.col("_metadata.file_path"), "\\d{4}-\\d{2}-\\d{2}", 0)
    return reader.format("text").load(path).select("value", day.alias("log_day"))
