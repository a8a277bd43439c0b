"""Joins of two streams by key whose rows live for a time that reading renews, as change rows.

A row is kept for ``ttl`` milliseconds after its time. A row that comes reads all rows of the
other side with its key that are still kept, and is paired with them. On a side whose
rows the join must show even alone (both of a full join, the left of a left join), being read
renews the row's life. A row without a partner is given out alone at once if its side is to
be shown, and taken back when its first partner comes, so the output is rows of ``change``
+1 and -1; ``live_rows`` folds them to the table they stand for.

The rows of a micro-batch count as coming by time, the left side first, then by their text; a
row whose time is behind that of an earlier micro-batch is paired by its own time.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Mapping

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidemart.functions.times import millis_time
from tidemart.operators.joins import LEFT, RIGHT

# The processors travel to the workers by value, so no worker needs this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHANGE, AT = "change", "at"
#: Which sides a join shows even without a partner.
SHOWN = {"inner": (False, False), "left": (True, False), "right": (False, True), "full": (True, True)}

_KEPT = "value string, expiry long, matched boolean"
_CHANGES = "change int, at long, left string, right string"
_COLUMNS = [c.split()[0] for c in _CHANGES.split(", ")]
_CHUNK = 10_000


def replay(
    arrivals: Iterable[tuple[int, int, str]], kept: tuple[list, list], ttl: int,
    shown: tuple[bool, bool], renewed: tuple[bool, bool],
) -> Iterator[tuple[int, int, str | None, str | None]]:
    """Changes that (time, side, text) cause, in order; ``kept`` holds [text, expiry, matched] per side."""
    for at, side, value in arrivals:
        other = 1 - side
        kept[other][:] = [row for row in kept[other] if row[1] >= at]
        for row in kept[other]:
            pair = (value, row[0]) if side == 0 else (row[0], value)
            if shown[other] and not row[2]:
                yield -1, at, *((row[0], None) if other == 0 else (None, row[0]))
            row[2] = True
            if renewed[other]:
                row[1] = max(row[1], at + ttl)
            yield 1, at, *pair
        met = bool(kept[other])
        if shown[side] and not met:
            yield 1, at, *((value, None) if side == 0 else (None, value))
        kept[side].append([value, at + ttl, met])


class ExpiringJoin(StatefulProcessor):
    """A list of kept rows per side. One timer stands at the earliest expiry and frees what is over."""

    def __init__(self, ttl: int, shown: tuple[bool, bool], renewed: tuple[bool, bool]) -> None:
        self._ttl, self._shown, self._renewed = ttl, shown, renewed

    def init(self, handle) -> None:
        self._handle = handle
        self._sides = (handle.getListState("left", _KEPT), handle.getListState("right", _KEPT))

    def _read(self) -> tuple[list, list]:
        return tuple([list(row) for row in side.get()] for side in self._sides)

    def _write(self, kept: tuple[list, list]) -> None:
        for state, rows in zip(self._sides, kept):
            if rows:
                state.put([tuple(row) for row in rows])
            else:
                state.clear()
        ends = [row[1] for rows in kept for row in rows]
        if ends:
            self._handle.registerTimer(min(ends) + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kept = self._read()
        every = pd.concat(list(rows), ignore_index=True)
        arrivals = sorted(zip(every["at"].tolist(), every["side"].tolist(), every["value"].tolist()))
        out = []
        for change in replay(arrivals, kept, self._ttl, self._shown, self._renewed):
            out.append(change)
            if len(out) == _CHUNK:
                yield pd.DataFrame(out, columns=_COLUMNS)
                out = []
        self._write(kept)
        if out:
            yield pd.DataFrame(out, columns=_COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        seen = timerValues.getCurrentWatermarkInMs()
        self._write(tuple([row for row in side if row[1] >= seen] for side in self._read()))
        return iter([])

    def close(self) -> None:
        pass


def expiring_join(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], times: tuple[str, str], ttl: int,
    how: str = "inner", renew: bool = True, delay: str | None = None, salts: int = 1,
) -> DataFrame:
    """Changes of the join: ``change``, ``at``, the left columns under ``l_`` and the right under ``r_``.

    ``renew=False`` lets every row expire ``ttl`` after its own time. State is freed once the
    watermark, ``delay`` (by default ``ttl``) behind the latest time, has passed a row's expiry; a row
    that comes later than that is dropped. Rows with a null key have no partner and keep no state;
    rows without a time are taken for too late.

    With ``salts`` the left rows of a key are dealt to so many tasks and the right rows copied to each,
    which is exact where right rows are not shown alone (inner and left joins).
    """
    shown = SHOWN[how]
    if salts > 1 and shown[1]:
        raise ValueError("a side that is copied cannot be shown alone")
    keys = [f"_k{n}" for n in range(len(on))]

    def side(df: DataFrame, number: int, names: Iterable[str]) -> DataFrame:
        parts = [F.col(name).cast("string").alias(k) for k, name in zip(keys, names)]
        time = F.col(times[number])
        return df.where(time.isNotNull()).select(
            *parts, F.lit(number).alias("side"), time.cast("long").alias("at"), F.to_json(F.struct(*df.columns)).alias("value"))

    both = [side(left, 0, on.keys()), side(right, 1, on.values())]
    if salts > 1:
        own = F.pmod(F.xxhash64("value"), F.lit(salts)).cast("int")
        both = [both[0].withColumn("_salt", own),
                both[1].withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))]
    every = both[0].unionByName(both[1]).withColumn("_rt", millis_time("at"))
    every = every.withWatermark("_rt", delay or f"{ttl} milliseconds")
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    by = [*keys, "_salt"] if salts > 1 else keys
    changes = every.where(keyed).groupBy(*by).transformWithStateInPandas(
        ExpiringJoin(ttl, shown, shown if renew else (False, False)), _CHANGES, "append", "eventTime")
    for number in (0, 1):
        if shown[number]:
            alone = every.where(~keyed & (F.col("side") == number))
            value, none = F.col("value"), F.lit(None).cast("string")
            changes = changes.unionByName(alone.select(
                F.lit(1).alias(CHANGE), AT, (none if number else value).alias("left"), (value if number else none).alias("right")))

    def unpacked(text: str, df: DataFrame, prefix: str) -> list[Column]:
        return [F.from_json(text, df.schema).getField(name).alias(prefix + name) for name in df.columns]

    return changes.select(CHANGE, AT, *unpacked("left", left, LEFT), *unpacked("right", right, RIGHT))


def live_rows(changes: DataFrame) -> DataFrame:
    """The table that a join's changes add up to; rows that come several times stay so."""
    columns = [name for name in changes.columns if name not in (CHANGE, AT)]
    sums = changes.groupBy(*columns).agg(F.sum(CHANGE).alias(CHANGE)).where(F.col(CHANGE) > 0)
    return sums.withColumn(CHANGE, F.explode(F.sequence(F.lit(1), F.col(CHANGE).cast("int")))).drop(CHANGE)
