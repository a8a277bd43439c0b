"""New-visitor repair, unique visits and bounces on an unbounded page log.

Input rows are page records with ``event_id`` and ``rt``, the event time as a timestamp.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemart.functions.times import millis_date, millis_time, slice_of
from tidemart.operators.visits import MATCHED, SLICES_PER_TIMEOUT, TIMED_OUT, look_ahead_slices

# The processors travel to the workers by value, so no worker needs this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

def with_event_time(pages: DataFrame, delay: str) -> DataFrame:
    return pages.withColumn("rt", millis_time("ts")).withWatermark("rt", delay)


_VISIT = "mid string, day int, at long, number long, value string"
_SEEN = "day array<int>, written array<long>"
_LAST = (1 << 63) - 1
#: Days of a visitor that share a state, and the day of entries without a time.
_DAYS, _NO_DAY = 8, -(1 << 31)


class FirstOfDay(StatefulProcessor):
    """The first row of each day of a key, once; the mark that a day was seen expires ``ttl`` after it is written.

    A key is a visitor and a few days, whose marks are read and written together. Reading does not
    renew a mark. The time is the clock's, not the events', so a row may lie behind others as far
    as it likes.
    """

    def __init__(self, ttl: int | None) -> None:
        self._ttl = ttl

    def init(self, handle) -> None:
        self._seen = handle.getValueState("seen", _SEEN, ttlDurationMs=self._ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        kept = self._seen.get()
        seen = {} if kept is None else dict(zip(*kept))
        if self._ttl is not None:
            seen = {day: written for day, written in seen.items() if written + self._ttl > now}
        first: dict[int, Row] = {}
        for row in rows:
            best = first.get(row.day)
            if row.day not in seen and (best is None or (row.at, row.number) < (best.at, best.number)):
                first[row.day] = row
        if first:
            seen.update(dict.fromkeys(first, now))
            self._seen.update((list(seen.keys()), list(seen.values())))
        for row in first.values():
            yield Row(mid=row.mid, day=row.day, at=row.at, number=row.number, value=row.value)

    def close(self) -> None:
        pass


def _first_in_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each Arrow batch the first row of every visitor and day."""
    for batch in batches:
        mid = batch.column(0).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        day, at, number = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
        order = np.lexsort((number, at, day, mid))
        first = np.ones(len(order), bool)
        first[1:] = (np.diff(mid[order]) != 0) | (day[order][1:] != day[order][:-1])
        yield batch.take(pa.array(order[first]))


def unique_visits(pages: DataFrame, keep: int | None = 24 * 3_600_000, salts: int = 1) -> DataFrame:
    """The first entry page of each visitor and day, by arrival, as a whole record.

    What was seen is remembered for ``keep`` milliseconds of the clock after it was first seen, and
    forever if None; how late an entry may come does not depend on it. Within a micro-batch the
    first is the least (ts, event_id). Repeats are first dropped where they are read, so of a busy
    visitor a row per day and Arrow batch is shuffled. With ``salts`` over one they are then dropped
    within so many parts of each visitor, at the price of a second state. State is kept per visitor and
    a few days. Entries without a visitor are one visitor's, entries without a time one day's.
    """
    entries = pages.where(F.col("page.last_page_id").isNull())
    rows = entries.select(
        F.col("common.mid").alias("mid"), F.coalesce(F.unix_date(millis_date("ts")), F.lit(_NO_DAY)).alias("day"),
        F.coalesce("ts", F.lit(_LAST)).alias("at"), F.coalesce("event_id", F.lit(_LAST)).alias("number"),
        F.to_json(F.struct(*pages.columns)).alias("value"),
    ).mapInArrow(_first_in_batch, _VISIT)
    block = F.floor(F.col("day") / _DAYS).alias("_block")
    if salts > 1:
        salted = rows.select("*", block, F.pmod(F.hash("number"), F.lit(salts)).alias("_salt"))
        rows = salted.groupBy("mid", "_block", "_salt").transformWithState(
            FirstOfDay(keep), _VISIT, "append", "processingTime")
    found = rows.select("*", block).groupBy("mid", "_block").transformWithState(
        FirstOfDay(keep), _VISIT, "append", "processingTime")
    return found.select(F.from_json("value", pages.schema).alias("_row")).select("_row.*")


_CLAIM = StructType([
    StructField("mid", StringType()), StructField("event_id", LongType()),
    StructField("ts", LongType()), StructField("is_new", StringType()),
    StructField("value", StringType()),
])


def _arrival(row) -> tuple:
    """Order of arrival within a batch; a record without a time comes last."""
    return row.ts is None, row.ts or 0, row.event_id


class FirstClaim(StatefulProcessor):
    """Leaves the flag to the first claim ever of a key; state does not expire.

    Within a batch the first is the least (ts, event_id), found in one pass without
    holding the rows. Rows that claim nothing pass as they are.
    """

    def init(self, handle) -> None:
        self._seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        def out(row, flag):
            return Row(mid=key[0], event_id=row.event_id, ts=row.ts, is_new=flag, value=row.value)

        seen, best = None, None
        for row in rows:
            if row.is_new != "1":
                yield out(row, row.is_new)
                continue
            if seen is None:
                seen = self._seen.exists()
            if seen:
                yield out(row, "0")
            elif best is None:
                best = row
            elif _arrival(row) < _arrival(best):
                yield out(best, "0")
                best = row
            else:
                yield out(row, "0")
        if best is not None:
            self._seen.update((True,))
            yield out(best, "1")

    def close(self) -> None:
        pass


def _first_claims(claims: DataFrame, part: Column) -> DataFrame:
    keyed = claims.withColumn("_part", part)
    return keyed.groupBy("mid", "_part").transformWithState(
        FirstClaim(), _CLAIM, outputMode="append", timeMode="none"
    )


def repair_new_flag(pages: DataFrame, salts: int = 8) -> DataFrame:
    """Streaming form of the repair: only claims of ``'1'`` pass through the state.

    All other records keep their flag and need neither shuffle nor Python. The claims of a
    visitor are first decided within ``salts`` parts. At most one claim per part is ever
    left for the second step, where the claims already refused are spread again, so no
    task receives all records of a busy visitor. One part skips the first step.
    """
    flag = F.col("common.is_new").eqNullSafe("1")
    rest = pages.where(~flag)
    body = [name for name in pages.columns if name not in ("event_id", "ts")]
    shape = StructType([pages.schema[name] for name in body])
    claims = pages.where(flag).select(
        F.col("common.mid").alias("mid"), "event_id", "ts",
        F.col("common.is_new").alias("is_new"), F.to_json(F.struct(*body)).alias("value"),
    )
    open_part = F.lit(0)
    if salts > 1:
        salt = 1 + F.pmod(F.hash("event_id"), F.lit(salts))
        claims = _first_claims(claims, salt)
        open_part = F.when(F.col("is_new") == "1", 0).otherwise(salt)
    decided = _first_claims(claims, open_part)
    back = decided.withColumn("_b", F.from_json("value", shape)).select(
        "event_id", "ts", "is_new", "_b.*"
    )
    back = back.withColumn("common", F.col("common").withField("is_new", F.col("is_new")))
    return rest.unionByName(back.select(*pages.columns))


_BUCKET = "ts array<long>, number array<long>, entry array<boolean>, own array<boolean>, value array<string>, mid array<string>"
_BOUNCE = "mid string, event_id long, ts long, bounce_kind string, value string"


class BounceFinder(StatefulProcessor):
    """Holds records of visitors until the watermark lets their entries be decided.

    The key is a group of visitors and a slice of time, so that visitors share reads and writes of
    state; rows that name no visitor are the key's. Records at the head of the next slice are here
    too, as copies that are no ``own`` entries of the slice. State is a map with one entry per
    bucket of time as long as the timeout. What decides an entry lies in its own bucket and the
    next one. One timer stands at the earliest timeout of an open entry, or bucket's end: it reads the
    buckets that are over by the watermark and the one after them, gives out what has timed out and
    keeps what is open, so a timer reads a bucket's rows once or twice, however long the slice is.
    """

    def __init__(self, timeout: int) -> None:
        self._timeout = timeout

    def init(self, handle) -> None:
        self._handle = handle
        self._buckets = handle.getMapState("buckets", "bucket long", _BUCKET)

    def _rows(self, bucket: int) -> list[tuple]:
        kept = self._buckets.getValue((bucket,))
        return [] if kept is None else list(zip(*kept))

    def _keep(self, bucket: int, rows: list[tuple]) -> None:
        self._buckets.updateValue((bucket,), tuple(map(list, zip(*rows))))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fresh: dict[int, list[tuple]] = {}
        for row in rows:
            mid = row.mid if "mid" in row else key[0]
            fresh.setdefault(row.ts // self._timeout, []).append(
                (row.ts, row.event_id, row.entry, row.own, row.value, mid))
        known = {key[0] for key in self._buckets.keys()}
        due = []
        for bucket, new in fresh.items():
            self._keep(bucket, [*self._rows(bucket), *new] if bucket in known else new)
            due.append(min((row[0] + self._timeout for row in new if row[3]), default=(bucket + 1) * self._timeout))
        if due:
            self._handle.registerTimer(min(due))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        seen = timerValues.getCurrentWatermarkInMs()
        buckets = sorted(found[0] for found in self._buckets.keys())
        over = [bucket for bucket in buckets if (bucket + 1) * self._timeout <= seen]
        later = [(bucket + 1) * self._timeout for bucket in buckets[len(over):][:1]]
        rows = {bucket: self._rows(bucket) for bucket in over}
        found, freed = [], []
        for bucket in over:
            open_ = None
            if any(row[3] for row in rows[bucket]):
                if bucket + 1 not in rows:
                    rows[bucket + 1] = self._rows(bucket + 1)
                near = sorted([*rows[bucket], *rows[bucket + 1]], key=lambda row: (row[5] is None, row[5] or "", *row[:2]))
                for (ts, number, _, mine, value, mid), after in zip(near, [*near[1:], None]):
                    if not mine or ts // self._timeout != bucket:
                        continue
                    if ts + self._timeout > seen:
                        open_ = ts if open_ is None else min(open_, ts)
                        continue
                    if after is None or after[5] != mid or after[0] - ts >= self._timeout:
                        kind = TIMED_OUT
                    elif after[2]:
                        kind = MATCHED
                    else:
                        continue
                    found.append(Row(mid=mid, event_id=number, ts=ts, bounce_kind=kind, value=value))
            if open_ is None:
                freed.append(bucket)
            else:
                self._keep(bucket, [row for row in rows[bucket] if row[0] >= open_])
                later.append(open_ + self._timeout)
        if len(freed) == len(buckets):
            self._buckets.clear()
        else:
            for bucket in freed:
                self._buckets.removeKey((bucket,))
        if later:
            self._handle.registerTimer(min(later))
        return iter(found)

    def close(self) -> None:
        pass


def bounce_details(
    pages: DataFrame, timeout: int = 10_000, delay: str = "14 seconds", width: int | None = None,
    groups: int = 1024,
) -> DataFrame:
    """Bounced entries, given out once the watermark has passed their timeout.

    State is held per slice of time, as in the batch form, so that catching up on a busy visitor is
    spread over its slices, and per group of visitors. ``groups`` is the number of these: a group's
    records of one timeout are read and written together, so more visitors ask for more groups.
    Records without a time are no one's neighbours and are left out.
    """
    body = [name for name in pages.columns if name not in ("event_id", "ts")]
    entry = F.col("page.last_page_id").isNull()
    width = width or SLICES_PER_TIMEOUT * timeout
    own = slice_of(F.col("ts"), width)
    spots = look_ahead_slices(F.col("ts"), timeout, width)
    mine = entry & (F.col("_slice") == own)
    rows = with_event_time(pages, delay).select("*", F.explode(spots).alias("_slice")).select(
        F.col("common.mid").alias("mid"), F.pmod(F.xxhash64("common.mid"), F.lit(groups)).cast("int").alias("_group"),
        "_slice", "event_id", "ts", "rt", entry.alias("entry"), mine.alias("own"),
        F.when(mine, F.to_json(F.struct(*body))).alias("value"),
    )
    shape = StructType([pages.schema[name] for name in body])
    found = rows.groupBy("_group", "_slice").transformWithState(
        BounceFinder(timeout), _BOUNCE, "append", "eventTime")
    return found.withColumn("_b", F.from_json("value", shape)).select(
        "event_id", "ts", "_b.*", "bounce_kind"
    )
