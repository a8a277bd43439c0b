"""Routing of a change stream by rules that change while it runs, and the tables they call for."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemart.operators.changes import (
    TO_DIMENSION, dimension_of, drop_deletes, latest_per_key, route, routed_dimensions, rule_shape,
)
from tidemart.sinks.tables import BatchWriter

BATCH = "batch_id"


def routed_batches(
    read_rules: Callable[[SparkSession], DataFrame], write: BatchWriter
) -> BatchWriter:
    """Batch writer that routes each micro-batch by the rules in force when it runs.

    ``read_rules`` is called inside the batch, so a rule changed since the last batch
    counts, and a query need not be restarted for it.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        rules = read_rules(batch.sparkSession)
        write(route(drop_deletes(batch), rules), batch_id)

    return run


_EXTENSION = re.compile(r"([A-Za-z_][\w.]*)\s*=\s*('[^']*'|[^,\s]+)")


def extension_options(sink_extend: str | None) -> dict[str, str]:
    """The ``name = value`` parts of a rule's table suffix, such as ``SALT_BUCKETS = 4``."""
    return {name: value.strip("'") for name, value in _EXTENSION.findall(sink_extend or "")}


def create_from_rule(
    spark: SparkSession, name: str, shape: StructType, key: str, options: dict[str, str], path: str
) -> None:
    """The catalog table of a dimension: text columns, a required key, one partition per micro-batch."""
    columns = ", ".join(f"`{f.name}` STRING{'' if f.nullable else ' NOT NULL'}" for f in shape.fields)
    told = {"dimension.key": key} | {f"dimension.option.{n}": v for n, v in options.items()}
    properties = ", ".join("'{}' = '{}'".format(n, v.replace("'", r"\'")) for n, v in told.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, `{BATCH}` BIGINT) USING parquet "
        f"PARTITIONED BY (`{BATCH}`) LOCATION '{path}' TBLPROPERTIES ({properties})")


def current_dimension(spark: SparkSession, name: str) -> DataFrame:
    """The live rows of a dimension's table: of each key the row of the last micro-batch."""
    told = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return latest_per_key(spark.table(name), [told["dimension.key"]], BATCH).drop(BATCH)


def dimension_batches(
    read_rules: Callable[[SparkSession], DataFrame], root: str, prefix: str = ""
) -> BatchWriter:
    """Batch writer that makes the tables of dimensions as rules name them, and fills them.

    The rules are read inside the batch: the first one that names a dimension creates its table
    ``prefix + sink_table``, with the columns, the key and the table suffix of the rules, and that
    batch and later ones put the last row of each of their keys in. A batch is routed and
    written once, by dimension. Repeated batches replace what they wrote. Rows without a key are
    in the routed layer only. One small job per dimension; their number is that of the rules' tables.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rules = read_rules(spark).where(F.col("sink_type") == TO_DIMENSION)
        named: dict[str, str | None] = {}
        for row in rules.select("sink_table", "sink_extend").distinct().collect():
            named[row.sink_table] = row.sink_extend or named.get(row.sink_table)
        layer = f"{root}/routed/batch_id={batch_id}"
        routed = routed_dimensions(route(drop_deletes(batch), rules))
        routed.write.mode("overwrite").partitionBy("sinkTable").parquet(layer)
        rows = spark.read.schema(routed.schema).parquet(layer)
        for table, extend in sorted(named.items()):
            shape, key = rule_shape(rules, table)
            create_from_rule(spark, prefix + table, shape, key, extension_options(extend), f"{root}/{table}")
            filled = dimension_of(rows, table, shape, key).where(F.col(key).isNotNull())
            filled.createOrReplaceTempView("_dimension_rows")
            columns = ", ".join(f"`{c}`" for c in shape.fieldNames())
            spark.sql(
                f"INSERT OVERWRITE TABLE {prefix}{table} PARTITION (`{BATCH}` = {batch_id}) "
                f"SELECT {columns} FROM _dimension_rows")

    return run
