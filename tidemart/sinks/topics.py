"""Topic sinks. Files stand in for Kafka where no broker is at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def write_topic(
    df: DataFrame, checkpoint: str, *, topic: str | None = None, format: str = "kafka",
    servers: str | None = None, path: str | None = None, available_now: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Start a query that writes ``value`` to one topic, or each row to its own.

    With ``topic`` every row goes there. Without it the rows carry a ``topic`` column,
    which Kafka follows by itself and by which a file sink is partitioned. The checkpoint
    makes restarts exact for files; Kafka may repeat a batch after a failure.
    """
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if format == "kafka":
        writer = writer.format("kafka").option("kafka.bootstrap.servers", servers)
        if topic is not None:
            writer = writer.option("topic", topic)
    else:
        writer = writer.format(format).option("path", path)
        if topic is None:
            writer = writer.partitionBy("topic")
    writer = (
        writer.trigger(availableNow=True) if available_now
        else writer.trigger(processingTime=interval)
    )
    return writer.start()


def print_rows(
    df: DataFrame, checkpoint: str, tag: str, mode: str = "append", format: str = "console",
    available_now: bool = False, path: str | None = None,
) -> StreamingQuery:
    """Show a stream, for a look at it: on the console, as files, or as the table ``tag`` with ``memory``.

    With a file format the tasks write the rows to ``path``, to be read there. The memory form holds
    all rows on the driver and is for small streams alone.
    """
    writer = df.writeStream.format(format).queryName(tag).outputMode(mode).option("checkpointLocation", checkpoint)
    if path is not None:
        writer = writer.option("path", path)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
