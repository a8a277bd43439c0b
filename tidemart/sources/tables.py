"""Dimension tables and database queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.functions.names import camel_columns


def read_dimension(
    spark: SparkSession, location: str, format: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    return spark.read.format(format).options(**(options or {})).load(location)


def by_key(dim: DataFrame, value: str, key: str = "id") -> DataFrame:
    """The row of one key; the filter reaches the scan."""
    return dim.where(F.col(key) == value)


def read_query(
    spark: SparkSession, url: str, query: str, *, camel: bool = False,
    options: dict[str, str] | None = None, format: str = "jdbc",
) -> DataFrame:
    """Result of a database query, if wanted with camel-case names.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` with
    ``dbtable`` in ``options`` to read a large table in parallel; then leave ``query``
    empty.
    """
    reader = spark.read.format(format).option("url", url).options(**(options or {}))
    if query:
        reader = reader.option("query", query)
    rows = reader.load()
    return camel_columns(rows) if camel else rows
