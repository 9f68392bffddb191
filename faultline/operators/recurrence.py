"""Recurrence: the previous incident of the same interface and error family.

A plain ``lag`` over (interface, family) would sort each group in one task, and
one group may hold a large share of all incidents. Here time is cut into slices:
hours for the pair totals, which are reduced with map-side combine first, and ten
minutes for the rows. The largest sort is then the incidents of one key in one
slice, or one row per slice of one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEYS = ("primary_interface", "error_family")
SLICE_MINUTES = 10


def within_hours(later: Column, earlier: Column, hours: int) -> Column:
    """Whether the gap is at most ``hours``; NULL when there is no earlier time."""
    return later <= F.timestamp_add("HOUR", F.lit(hours), earlier)


def _keyed(df: DataFrame, keys: tuple[str, ...], ts: str) -> Column:
    present = F.col(ts).isNotNull()
    for k in keys:
        present = present & F.col(k).isNotNull()
    return present


def time_slice(ts: Column, minutes: int = 60) -> Column:
    """Number of the stretch of ``minutes`` (a part of an hour), counted from 1970-01-01."""
    hour = F.unix_date(ts.cast("date")).cast("long") * 24 + F.hour(ts)
    return hour * (60 // minutes) + F.floor(F.minute(ts) / minutes)


def add_recurrence(
    df: DataFrame,
    ts: str = "opened_dt",
    keys: tuple[str, ...] = KEYS,
    order: str = "number",
    hours: int = 24,
) -> DataFrame:
    """Append ``prev_time`` and ``recurs_24h``.

    ``prev_time`` is the opening time of the previous incident with the same
    keys, in order of time then ``order``; NULL when a key is NULL or nothing
    precedes. ``recurs_24h`` is true when the gap is at most ``hours``.

    One scan, nothing written. Inside a slice an incident looks back to the one
    before it. The first of a slice looks back to the *latest time* of the nearest
    earlier slice, which no order among equal times can change; for that only one
    row per slice and key meets in a group, the others stay by themselves.
    """
    keyed = _keyed(df, keys, ts)
    # Rows without a key or time never look back; by themselves they are no hot group.
    rows = df.withColumns({"_slice": F.when(keyed, time_slice(F.col(ts), SLICE_MINUTES)), "_own": F.when(~keyed, F.xxhash64(order, ts))})
    own_slice = W.partitionBy(*keys, "_slice", "_own")
    ordered = own_slice.orderBy(ts, order)
    inside = rows.withColumns(
        {
            "_inside": F.lag(ts).over(ordered),
            "_first": F.row_number().over(ordered) == 1,
            "_last": F.max(ts).over(own_slice),
        }
    )
    apart = F.when(~F.col("_first"), F.col("_slice"))
    across = W.partitionBy(*keys, "_own", "_apart").orderBy("_slice")
    linked = inside.withColumn("_apart", apart).withColumn("_carried", F.lag("_last").over(across))
    prev = F.when(F.col("_slice").isNotNull(), F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_inside")))
    return (
        linked.withColumn("prev_time", prev)
        .withColumn("recurs_24h", F.coalesce(within_hours(F.col(ts), F.col("prev_time"), hours), F.lit(False)))
        .select(*df.columns, "prev_time", "recurs_24h")
    )


def recurrence_pairs(
    df: DataFrame, ts: str = "opened_dt", keys: tuple[str, ...] = KEYS, hours: int = 24
) -> DataFrame:
    """Recurrences per (interface, family), most first; NULL keys are left out.

    Works on slices alone, without ordering incidents: a slice is no longer than
    ``hours`` (at least 1), so all its incidents but the first recur, and the
    first recurs when the end of the nearest earlier slice is near enough.
    """
    if hours < 1:
        raise ValueError("hours must be at least 1")
    # NULL keys are dropped after counting: a filter before it would be pushed
    # down and evaluate derived keys twice.
    slices = (
        df.groupBy(*keys, time_slice(F.col(ts)).alias("_slice"))
        .agg(
            F.sum(_keyed(df, keys, ts).cast("bigint")).alias("_n"), F.min(ts).alias("_from"), F.max(ts).alias("_to")
        )
        .where(F.col("_n") > 0)
    )
    before = F.lag("_to").over(W.partitionBy(*keys).orderBy("_slice"))
    near = F.coalesce(within_hours(F.col("_from"), F.col("_before"), hours), F.lit(False))
    return (
        slices.withColumn("_before", before)
        .groupBy(*keys)
        .agg(F.sum(F.col("_n") - 1 + near.cast("bigint")).alias("recurs_24h_count"))
        .orderBy(F.col("recurs_24h_count").desc(), *keys)
    )
