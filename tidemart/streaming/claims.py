"""New-visitor repair of micro-batches against a table of first claims.

The table holds the first claim of every visitor so far: visitor, record number and time, in buckets
by visitor. A micro-batch finds the first claim of each of its visitors by aggregates that combine
before their shuffle, keeps those of visitors the table lacks by an anti-join, which need not
move the stored side, and adds them. Only these narrow rows move, and no Python runs.

A row of the table names the micro-batch that added it, and a micro-batch writes a partition of its
own, so a repeated one sees what it saw and replaces what it wrote. Every ``merge_every`` micro-batches
the partitions are merged into one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart.sinks.tables import BatchWriter

_LATE = (1 << 63) - 1


def create_claims(spark: SparkSession, table: str, buckets: int = 64) -> None:
    """The table of first claims, in the catalog's warehouse."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} (visitor STRING, number BIGINT, time BIGINT, added BIGINT, part STRING) "
        f"USING parquet PARTITIONED BY (part) CLUSTERED BY (visitor) SORTED BY (visitor) INTO {buckets} BUCKETS")


def _visitor() -> Column:
    return F.coalesce(F.col("common.mid"), F.lit(""))


def _replace(rows: DataFrame, table: str, part: str) -> None:
    """Write one partition, in place of what an earlier try wrote; ``rows`` may read the others."""
    rows.createOrReplaceTempView("_claims_to_write")
    rows.sparkSession.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (part = '{part}')")
    rows.sparkSession.sql(
        f"INSERT INTO {table} PARTITION (part = '{part}') SELECT visitor, number, time, added FROM _claims_to_write")


def first_claims(claims: DataFrame, order: tuple[str, str] = ("ts", "event_id")) -> DataFrame:
    """(visitor, number, time) of each visitor's first claim; one without a time comes last.

    The least number per visitor and time, then the least time per visitor, so no visitor's
    claims meet in one task.
    """
    time, number = order
    late = F.coalesce(F.col(time), F.lit(_LATE))
    return (
        claims.groupBy(_visitor().alias("visitor"), late.alias("_late")).agg(F.min(number).alias("_n"))
        .groupBy("visitor").agg(F.min_by("_n", "_late").alias("number"), F.min("_late").alias("time"))
    )


def new_claims(batch: DataFrame, known: DataFrame) -> DataFrame:
    """First claims of the batch's visitors that have none in ``known``."""
    claims = batch.where(F.col("common.is_new") == "1")
    return first_claims(claims).join(known.select("visitor"), "visitor", "left_anti")


def flagged(batch: DataFrame, fresh: DataFrame) -> DataFrame:
    """The batch with the flag left to the claims in ``fresh`` alone; other records pass unmoved."""
    claim = F.col("common.is_new").eqNullSafe("1")
    ours = fresh.select(
        F.col("visitor").alias("_visitor"), F.col("number").alias("_number"), F.col("time").alias("_time"),
        F.lit("1").alias("_kept"))
    match = (
        (_visitor() == F.col("_visitor")) & F.col("event_id").eqNullSafe(F.col("_number"))
        & (F.coalesce("ts", F.lit(_LATE)) == F.col("_time")))
    joined = batch.where(claim).join(ours, match, "left")
    repaired = joined.withColumn(
        "common", F.col("common").withField("is_new", F.coalesce("_kept", F.lit("0"))))
    return batch.where(~claim).unionByName(repaired.select(*batch.columns))


def repairing(table: str, write: BatchWriter, merge_every: int = 50) -> BatchWriter:
    """Writer that repairs each micro-batch of page records by the table and hands it on.

    Missing and empty visitor ids are one visitor. In a batch the least (ts, event_id) is first; a
    visitor's claim in an earlier batch precedes them all.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = spark.table(table).where(F.col("added") < batch_id)
        fresh = new_claims(batch, known).withColumn("added", F.lit(batch_id).cast("long"))
        _replace(fresh, table, f"batch-{batch_id}")
        write(flagged(batch, spark.table(table).where(F.col("part") == f"batch-{batch_id}")), batch_id)
        if (batch_id + 1) % merge_every == 0:
            merge(spark, table, batch_id)

    return run


def merge(spark: SparkSession, table: str, batch_id: int) -> None:
    """Write all claims up to a batch as one partition and drop the others, but the batch's own.

    Each try writes a partition of a new name before it drops any, so one that fails loses nothing.
    """
    merged, own = f"upto-{batch_id}-{uuid.uuid4().hex}", f"batch-{batch_id}"
    rows = spark.table(table).where(F.col("added") <= batch_id)
    _replace(rows.drop("part").distinct(), table, merged)
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        part = row[0].split("=", 1)[1]
        if part not in (merged, own):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (part = '{part}')")
