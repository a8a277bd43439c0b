"""Column-name conversion for records read from a database."""

from __future__ import annotations

from pyspark.sql import DataFrame


def camel(name: str) -> str:
    head, *rest = name.lower().split("_")
    return head + "".join(part.capitalize() for part in rest)


def camel_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[camel(name) for name in df.columns])
