"""Change captures: the first snapshot and the tail, as envelopes (topic, offset, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemart.operators.changes import current_table, image_columns

CHANGE_COLUMNS = "topic string, offset long, value string"


def read_changes(
    spark: SparkSession, *, topics: str, format: str = "kafka", servers: str | None = None,
    path: str | None = None, initial: bool = True, stream: bool = True,
) -> DataFrame:
    """Raw envelopes of the topics that match the pattern ``topics``.

    ``initial`` reads the captured snapshot and then the tail, otherwise the tail alone.
    Files hold the columns topic, offset and value; a snapshot's rows have offsets below zero.
    """
    reader = (spark.readStream if stream else spark.read).format(format)
    if format == "kafka":
        starting = "earliest" if initial or not stream else "latest"
        reader = (
            reader.option("kafka.bootstrap.servers", servers)
            .option("subscribePattern", topics).option("startingOffsets", starting)
        )
        return reader.load().selectExpr("topic", "offset", "cast(value as string) value")
    envelopes = reader.schema(CHANGE_COLUMNS).load(path)
    if not initial:
        envelopes = envelopes.where("offset >= 0")
    return envelopes.where(F.col("topic").rlike(f"^({topics})$"))


def snapshot_envelopes(table: DataFrame, topic: str, before_all: int = -1) -> DataFrame:
    """Rows of a database table as read events that come before every change."""
    _, database, name = topic.split(".")
    text = F.to_json(F.struct(
        F.struct("*").alias("after"),
        F.struct(F.lit(database).alias("db"), F.lit(name).alias("table")).alias("source"),
        F.lit("r").alias("op"),
    ))
    return table.select(
        F.lit(topic).alias("topic"), F.lit(before_all).cast("long").alias("offset"),
        text.alias("value"),
    )


def changelog_table(
    changes: DataFrame, view: str, schema: StructType, key: str = "id", order: str = "offset"
) -> DataFrame:
    """The live rows behind normalised changes of one table, as an SQL table."""
    live = image_columns(current_table(changes, key, order), schema)
    live.createOrReplaceTempView(view)
    return live
