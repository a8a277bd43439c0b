"""Helpers shared by the operators: tables in the shared folder and row keys.

A row key is (``doc_id``, xxHash64 of the text). Equal rows share a key, so a result that is
joined back by key reaches each of them, and a null id is an id like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart.session import fresh_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and tells the planner the table's true size,
    by which it decides whether a broadcast is safe.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def unused(columns: list[str], *names: str) -> tuple[str, ...]:
    """The names, lengthened until none is one of the columns, whose case does not count."""
    taken = {c.lower() for c in columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return tuple(found)


def left_join(left: DataFrame, right: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Left join on columns that may be null; ``right`` has at most one row per key."""
    other = right.select(*[F.col(n).alias(f"_r_{n}") for n in names],
                         *[c for c in right.columns if c not in names])
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).eqNullSafe(F.col(f"_r_{name}"))
    return left.join(other, condition, "left").drop(*[f"_r_{n}" for n in names])
