"""Layers that are written once and read by many: the article dimension and the statistics.

A layer belongs to one application and one folder of tables. It is built when it is first
asked for, by ``layer`` or ahead of time by ``build_statistics``, and again when the version stamp of
one of its own tables has changed or with ``rebuild=True``. Statistics are partitioned by the leading
part of their window start and sorted within, so a report of a period reads its partitions alone.
``periods`` keeps statistics up to date without building them anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from tidemart.session import fresh_dir

PERIOD = "dt"

#: Places that the rows of one period are dealt to, at least.
PLACES = 2

Stamp = tuple[tuple[str, int, int, int], ...]

_built: dict[tuple[str, str, str], tuple[Stamp, str, StructType]] = {}

#: What writers leave in a table's folder when they finish: a job, and a streaming query.
_MARKS = ("_SUCCESS", "_spark_metadata")


def stamp_of(spark: SparkSession, folder: str, tables: tuple[str, ...] | None = None) -> Stamp:
    """A version stamp of a folder's tables, all by default, on any storage Spark reads.

    Per table it is the size and time of change of its file or folder and the time of the marks that
    writers leave in it: a few look-ups a table, however many files it has. A writer that changes
    files deep in a folder and leaves no mark is not seen.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    root = hadoop(folder)
    files = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if tables is None:
        found = [status.getPath() for status in files.listStatus(root)]
    else:
        found = [path for path in (hadoop(root, f"{name}.parquet") for name in tables) if files.exists(path)]
    stamp = []
    for path in found:
        status, marked = files.getFileStatus(path), 0
        if status.isDirectory():
            marks = [hadoop(path, mark) for mark in _MARKS]
            marked = max([files.getFileStatus(m).getModificationTime() for m in marks if files.exists(m)], default=0)
        size = 0 if status.isDirectory() else status.getLen()
        stamp.append((path.getName(), size, status.getModificationTime(), marked))
    return tuple(sorted(stamp))


def dealt_by_period(rows: DataFrame) -> DataFrame:
    """Rows dealt to tasks by period, sorted by window start within each.

    A period goes by hash to a few places. Adaptive execution then splits what is too large for a task and
    joins what is small, so a busy period or window is written by several tasks and a sparse one shares
    a task. Ranges would need a sample, for which the statistics would be computed a second time.
    """
    place = F.pmod(F.xxhash64(*rows.columns), F.lit(PLACES)).alias("_place")
    dealt = rows.select("*", place).hint("rebalance", PERIOD, "_place").drop("_place")
    return dealt.sortWithinPartitions(PERIOD, "stt")


def layer(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame],
    period_width: int | None = None, rebuild: bool = False, tables: tuple[str, ...] | None = None,
) -> DataFrame:
    """The stored result of ``build``, which reads ``tables`` of the folder. With ``period_width``, partitioned by so many leading
    characters of ``stt``: 10 for days, 7 for months.

    Being stored, a layer's size is known when a job is planned, and so is whether it may be
    broadcast. Rows are dealt by ``dealt_by_period``.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    stamp = stamp_of(spark, sf_dir, tables)
    if rebuild or key not in _built or _built[key][0] != stamp:
        path, rows = fresh_dir(spark, name), build()
        if period_width:
            rows = rows.withColumn(PERIOD, F.substring("stt", 1, period_width))
            dealt_by_period(rows).write.partitionBy(PERIOD).parquet(path)
        else:
            rows.write.parquet(path)
        _built[key] = stamp, path, rows.schema
    _, path, schema = _built[key]
    if period_width:
        others = [f for f in schema.fields if f.name != PERIOD]
        schema = StructType(others).add(PERIOD, StringType())
    return spark.read.schema(schema).parquet(path)
