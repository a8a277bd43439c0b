"""Joins by key and time, and lookups in dimension tables.

No join here carries a broadcast hint. Spark broadcasts a dimension only when its size is
known to lie under ``spark.sql.autoBroadcastJoinThreshold`` (at planning time or, with
adaptive execution, from the finished shuffle); beyond that it sorts and merges, and
splits skewed partitions. Joins of two facts ask for a merge: the estimate for a fact file
is that of its compressed size, and too weak a ground for collecting it on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions.times import slice_of

LEFT, RIGHT = "l_", "r_"

# A copied row lands in one slice, or in two when its bounds cross an edge. With slices this
# many times longer than the bounds, every second row is copied, and a row of a hot key meets
# about three times the partners it keeps. Longer slices copy less and compare more.
SLICES_PER_SPAN = 2


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + name for name in df.columns])


def _sliced(
    fixed: DataFrame, copied: DataFrame, keys: Column, fixed_time: str,
    copied_time: str, lower: int, upper: int, width: int, how: str,
) -> DataFrame:
    """Pairs with ``copied_time`` in [fixed_time + lower, fixed_time + upper].

    Each row of ``fixed`` lies in one slice of time. Each row of ``copied`` is copied to
    every slice that can hold a partner, so a fixed row meets all of its partners in its
    own slice. One hot key is thus spread over its slices. Within a slice all rows of a key
    are paired and those out of bounds dropped, so a slice is kept not much longer than the
    bounds. As no fixed row is copied, outer and anti forms are exact.
    """
    here, there = F.col(fixed_time), F.col(copied_time)
    fixed = fixed.withColumn("_slice", slice_of(here, width))
    spots = F.sequence(slice_of(there - upper, width), slice_of(there - lower, width))
    copied = copied.select("*", F.explode(spots).alias("_copy_slice"))
    close = there.between(here + lower, here + upper)
    near = keys & (F.col("_slice") == F.col("_copy_slice")) & close
    joined = fixed.join(copied.hint("merge"), near, how)
    return joined.drop("_slice", "_copy_slice")


def _full(
    left: DataFrame, right: DataFrame, keys: Column, left_time: str, right_time: str,
    lower: int, upper: int, width: int,
) -> DataFrame:
    """Pairs with ``right_time`` in [left_time + lower, left_time + upper], and all rows without one.

    Each side is read and shuffled once. A row lies in its own slice of time and, as a copy, in
    every slice that can hold a partner, so in its own slice it meets all of its partners,
    themselves or as copies. A pair counts in the left row's slice, and a row without a partner in
    its own, so what copies meet or miss is dropped.
    """
    here, there = F.col(left_time), F.col(right_time)

    def spread(df: DataFrame, time: Column, low: int, high: int, slice_: str, home: str) -> DataFrame:
        own = slice_of(time, width)
        spots = F.array_union(F.array(own), F.sequence(slice_of(time + low, width), slice_of(time + high, width)))
        return df.select("*", F.explode_outer(spots).alias(slice_)).withColumn(home, F.col(slice_).eqNullSafe(own))

    a = spread(left, here, lower, upper, "_slice", "_home")
    b = spread(right, there, -upper, -lower, "_copy_slice", "_copy_home")
    near = keys & (F.col("_slice") == F.col("_copy_slice")) & there.between(here + lower, here + upper)
    joined = a.join(b.hint("merge"), near, "full")
    return joined.where(F.coalesce("_home", "_copy_home"))


def interval_join(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], times: tuple[str, str],
    lower: int, upper: int, how: str = "inner", copy: str = "right",
    width: int | None = None,
) -> DataFrame:
    """Pairs of equal key with the right time in [left + lower, left + upper].

    Times and bounds are milliseconds, both ends count. The result holds the left
    columns under ``l_`` and the right ones under ``r_``. ``copy`` names the side an
    inner join copies over slices: the smaller one is the better choice.
    """
    width = width or max(SLICES_PER_SPAN * (upper - lower), 1)
    a, b = prefixed(left, LEFT), prefixed(right, RIGHT)
    at, bt = LEFT + times[0], RIGHT + times[1]
    keys = None
    for x, y in on.items():
        pair = F.col(LEFT + x) == F.col(RIGHT + y)
        keys = pair if keys is None else keys & pair
    columns = a.columns + b.columns

    def keep_left(kind: str) -> DataFrame:
        return _sliced(a, b, keys, at, bt, lower, upper, width, kind)

    def keep_right(kind: str) -> DataFrame:
        return _sliced(b, a, keys, bt, at, -upper, -lower, width, kind)

    if how == "inner":
        joined = keep_right("inner") if copy == "left" else keep_left("inner")
    elif how == "left":
        joined = keep_left("left")
    elif how == "right":
        joined = keep_right("left")
    elif how == "full":
        joined = _full(a, b, keys, at, bt, lower, upper, width)
    else:
        raise ValueError(f"unknown join kind: {how}")
    return joined.select(*columns)


def ttl_join(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], times: tuple[str, str],
    ttl: int, how: str = "inner",
) -> DataFrame:
    """Join of two tables whose rows expire ``ttl`` milliseconds after they arrive.

    A pair exists when the later row came while the earlier one was still kept. The
    rule that reading a row renews its life, which the outer forms of the original
    follow on their preserved side, has no counterpart here.
    """
    return interval_join(left, right, on, times, -ttl, ttl, how)


def enrich(
    df: DataFrame, dim: DataFrame, key: str, take: Mapping[str, Column | str],
    dim_key: str = "id",
) -> DataFrame:
    """Left lookup: add the columns of ``take`` from the dimension row with that key.

    A row without a partner passes unchanged, with nulls. The dimension holds one row
    per key. Its key, which is text, is cast to the type of the fact key, so the fact
    side is not recomputed; a dimension row whose key cannot be read is left out.
    """
    wanted = [
        (F.col(value) if isinstance(value, str) else value).alias(name)
        for name, value in take.items()
    ]
    kind = df.select(key).schema[0].dataType
    read = F.col(dim_key).try_cast(kind)
    side = dim.where(read.isNotNull()).select(read.alias("_key"), *wanted)
    kept = [name for name in df.columns if name not in take]
    joined = df.select(*kept).join(side, F.col(key) == F.col("_key"), "left")
    return joined.drop("_key")


def sku_snowflake(
    sku: DataFrame, spu: DataFrame, trademark: DataFrame, category3: DataFrame
) -> DataFrame:
    """The article dimension with the three dimensions its row points to.

    Joined once, so that facts need one lookup and not a chain of four.
    """
    base = sku.select(
        "id", "sku_name", F.col("price").try_cast("decimal(16,2)").alias("sku_price"),
        *[F.col(name).try_cast("long").alias(name) for name in ("spu_id", "tm_id", "category3_id")],
    )
    base = enrich(base, spu, "spu_id", {"spu_name": "spu_name"})
    base = enrich(base, trademark, "tm_id", {"tm_name": "tm_name"})
    return enrich(base, category3, "category3_id", {"category3_name": "name"})
