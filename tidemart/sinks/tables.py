"""Statistics tables and dimension tables, written from micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from tidemart.operators.changes import DELETED, latest_per_key, upsert

BatchWriter = Callable[[DataFrame, int], None]


def without(df: DataFrame, transient: Sequence[str]) -> DataFrame:
    """Drop the helper columns that a table does not hold."""
    return df.drop(*transient)


def stats_writer(
    path: str, columns: Sequence[str], transient: Sequence[str] = (), format: str = "parquet"
) -> BatchWriter:
    """Writer for ``foreachBatch``: one folder per batch, replaced if the batch is repeated."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = without(batch, transient).select(*columns)
        rows.write.format(format).mode("overwrite").save(f"{path}/batch_id={batch_id}")

    return write


def database_writer(
    url: str, table: str, columns: Sequence[str], properties: dict[str, str],
    batch_rows: int = 5000,
) -> BatchWriter:
    """Writer for ``foreachBatch`` into a database table, columns in declared order.

    At least once: a batch that is repeated after a failure is appended again. Its number is
    written along, by which the database can drop the earlier copy.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*columns).selectExpr("*", f"{batch_id}L as batch_id")
        rows.write.mode("append").option("batchsize", batch_rows).jdbc(
            url, table, properties=properties
        )

    return write


def create_dimension(
    spark: SparkSession, name: str, schema: StructType, path: str, format: str = "parquet"
) -> None:
    """Create the table of a rule unless it exists."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source=format, schema=schema)


# A dimension is a folder of ``base=N`` tables, each whole, and ``delta=N`` tables, each
# holding the rows one micro-batch changed. N is the number of the batch.
BASE, DELTA = "base", "delta"


def _parts(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the finished tables of one kind, oldest first."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(folder)]
    return sorted(
        int(name.split("=")[1]) for name in names
        if name.startswith(f"{kind}=") and files.exists(hadoop.Path(f"{path}/{name}/_SUCCESS"))
    )


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def read_current(
    spark: SparkSession, path: str, schema: StructType, key: str,
    upto: int | None = None, base_below: int | None = None,
) -> DataFrame:
    """The dimension as of batch ``upto``, by default as of the last one.

    ``base_below`` starts from a base older than that batch.
    """

    def numbers(kind: str) -> list[int]:
        return [n for n in _parts(spark, path, kind) if upto is None or n <= upto]

    bases = [n for n in numbers(BASE) if base_below is None or n < base_below]
    newest = bases[-1] if bases else -1
    if bases:
        current = spark.read.schema(schema).parquet(f"{path}/{BASE}={newest}")
    else:
        current = spark.createDataFrame([], schema)
    deltas = [f"{path}/{DELTA}={n}" for n in numbers(DELTA) if n > newest]
    if not deltas:
        return current
    marks = [StructField(DELETED, BooleanType()), StructField(DELTA, LongType())]
    numbered = StructType([*schema.fields, *marks])
    changed = spark.read.schema(numbered).option("basePath", path).parquet(*deltas)
    return upsert(current, latest_per_key(changed, [key], DELTA).drop(DELTA), key)


def dimension_writer(
    path: str, key: str, schema: StructType, prepare: Callable[[DataFrame], DataFrame],
    compact_every: int = 20,
) -> BatchWriter:
    """Writer for ``foreachBatch`` that keeps a dimension table up to date.

    ``prepare`` turns a batch into one row per key, which is all that the batch writes; a
    true ``_deleted`` column takes the row of that key away.
    Every ``compact_every`` batches the table is merged into a new base, and tables older
    than the base before it are removed. A repeated batch replaces its own tables, so the
    result is the same.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prepare(batch).write.mode("overwrite").parquet(f"{path}/{DELTA}={batch_id}")
        if (batch_id + 1) % compact_every:
            return
        # A repeated batch must not read the base it is about to replace.
        merged = read_current(spark, path, schema, key, upto=batch_id, base_below=batch_id)
        merged.write.mode("overwrite").parquet(f"{path}/{BASE}={batch_id}")
        older = [n for n in _parts(spark, path, BASE) if n < batch_id]
        for kind in (BASE, DELTA) if older else ():
            for number in _parts(spark, path, kind):
                if number < older[-1]:
                    _remove(spark, f"{path}/{kind}={number}")

    return write
