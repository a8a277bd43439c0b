"""Statistics kept up by period: rows are appended, and only the periods they touch are computed anew.

Inputs and statistics are tables of the catalog, partitioned by period: the leading characters of the
day, 10 for days and 7 for months. ``add`` puts the rows of a batch into partitions of its own, finds the
periods in which they can change something, computes these from the partitions that lie near
enough, and overwrites these partitions of the statistics. Other periods are neither read nor written,
and the work of a batch grows with the periods it touches, not with the history.

A repeated batch replaces its rows and ends in the same statistics. Rows without a time belong in
a dirty table and are refused.
"""

from __future__ import annotations

import calendar
import uuid
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemart.functions.times import millis_time, time_text
from tidemart.plans.layers import PERIOD, dealt_by_period

DAYS, MONTHS = 10, 7
_DAY = 86_400_000
_BATCH = "batch_id"


def _days_of(period: str) -> tuple[date, date]:
    """First and last day of a period."""
    if len(period) == DAYS:
        day = date.fromisoformat(period)
        return day, day
    year, month = map(int, period.split("-"))
    return date(year, month, 1), date(year, month, calendar.monthrange(year, month)[1])


def periods_near(periods: list[str], reach: int) -> list[str]:
    """The periods, and those that begin or end within ``reach`` milliseconds of one of them."""
    found = set(periods)
    margin = timedelta(days=-(-reach // _DAY))
    for period in periods:
        first, last = _days_of(period)
        for day in _each(first - margin, last + margin):
            found.add(day.isoformat()[: len(period)])
    return sorted(found)


def _each(first: date, last: date):
    while first <= last:
        yield first
        first += timedelta(days=1)


class PeriodStatistics:
    """Statistics of ``build`` over named inputs, as a table that grows batch by batch.

    ``times`` names each input's time in milliseconds. ``build`` takes the inputs and returns rows with
    their window start as text in ``stt``; windows lie within a period. ``reach`` is how
    far in time two input rows can be apart and still matter for each other.
    """

    def __init__(
        self, spark: SparkSession, path: str, schemas: dict[str, StructType], times: dict[str, str],
        build: Callable[[dict[str, DataFrame]], DataFrame], width: int = DAYS, reach: int = 0,
    ) -> None:
        self.spark, self.path, self.build, self.width, self.reach = spark, path, build, width, reach
        self.times = times
        name = f"kept_{uuid.uuid4().hex}"
        self.tables = {n: f"{name}_{n}" for n in schemas}
        self.statistics = f"{name}_statistics"
        for n, schema in schemas.items():
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            spark.sql(
                f"CREATE TABLE {self.tables[n]} ({columns}, {_BATCH} BIGINT, {PERIOD} STRING) USING parquet "
                f"PARTITIONED BY ({_BATCH}, {PERIOD}) LOCATION '{path}/{n}'")

    def _period(self, time: str) -> Column:
        return F.substring(time_text(millis_time(time)), 1, self.width)

    def add(self, batch_id: int, **rows: DataFrame) -> list[str]:
        """Append rows of the inputs and bring the statistics up to date; the periods computed anew."""
        touched: set[str] = set()
        for name, frame in rows.items():
            own = self.spark.table(self.tables[name])
            dated = frame.select(
                *[F.col(c) for c in own.columns if c not in (_BATCH, PERIOD)],
                F.when(F.col(self.times[name]).isNull(), F.raise_error(F.lit("a row has no time")))
                .otherwise(self._period(self.times[name])).alias(PERIOD))
            dated.createOrReplaceTempView("_rows_to_add")
            self.spark.sql(
                f"INSERT OVERWRITE TABLE {self.tables[name]} PARTITION ({_BATCH} = {batch_id}, {PERIOD}) "
                "SELECT * FROM _rows_to_add")
            # One row per period that the batch has.
            new = own.where(F.col(_BATCH) == batch_id).select(PERIOD).distinct().collect()
            touched.update(row[0] for row in new)
        periods = periods_near(sorted(touched), self.reach)
        if not periods:
            return []
        done = self.computed(periods).withColumn(PERIOD, F.substring("stt", 1, self.width))
        dealt_by_period(done).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(
            f"{self.path}/statistics")
        self._declare(done.schema, periods)
        return periods

    def computed(self, periods: list[str]) -> DataFrame:
        """The statistics of some periods, from the rows that lie near enough."""
        near = periods_near(periods, self.reach)
        read = {
            n: self.spark.table(t).where(F.col(PERIOD).isin(near)).drop(_BATCH, PERIOD)
            for n, t in self.tables.items()
        }
        found = self.build(read)
        return found.where(F.substring("stt", 1, self.width).isin(periods))

    def _declare(self, schema: StructType, periods: list[str]) -> None:
        """Tell the catalog of the statistics and of their partitions, which may be new."""
        if not self.spark.catalog.tableExists(self.statistics):
            columns = ", ".join(
                f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != PERIOD)
            self.spark.sql(
                f"CREATE TABLE {self.statistics} ({columns}, {PERIOD} STRING) USING parquet "
                f"PARTITIONED BY ({PERIOD}) LOCATION '{self.path}/statistics'")
        parts = " ".join(f"PARTITION ({PERIOD} = '{period}')" for period in periods)
        self.spark.sql(f"ALTER TABLE {self.statistics} ADD IF NOT EXISTS {parts}")
        self.spark.catalog.refreshTable(self.statistics)

    def table(self) -> DataFrame:
        """The statistics of all periods so far, with their period."""
        return self.spark.table(self.statistics)
