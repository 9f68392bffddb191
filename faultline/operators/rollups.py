"""Rollups over an enriched or extracted incident table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.extract import triplet_label
from .common import constant_table, value_counts
from .recurrence import KEYS, recurrence_pairs, time_slice, within_hours

__all__ = [
    "by_error_family", "by_triplet", "ci_error_pairs", "dow_counts", "dow_hour_matrix", "extract_stats",
    "histogram", "kpis", "monthly_trend", "pareto", "quality_checks", "recurrence_pairs", "value_counts",
]


def _share(flag: Column) -> Column:
    """Mean of a flag, 0 for no rows."""
    return F.coalesce(F.avg(flag.cast("int")), F.lit(0.0))


def kpis(df: DataFrame) -> DataFrame:
    """One row: total, closed and open incidents, share of intermittent ones."""
    closed = F.coalesce(
        F.sum(F.coalesce(F.col("status_canonical").isin(*P.CLOSED_STATUSES), F.lit(False)).cast("bigint")), F.lit(0)
    )
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total_incidents"),
        closed.alias("closed_incidents"),
        (total - closed).alias("open_incidents"),
        _share(F.col("is_intermittent")).alias("intermittent_ratio"),
    )


def ci_error_pairs(df: DataFrame, n: int | None = None) -> DataFrame:
    """Tickets per (ci, family), most first; a NULL CI is its own group.

    Counts non-null ticket numbers.
    """
    out = df.groupBy("ci", "error_family").agg(F.count("number").alias("count"))
    out = out.orderBy(F.col("count").desc(), "ci", "error_family")
    return out if n is None else out.limit(n)


def quality_checks(df: DataFrame, ts: str = "opened_dt", order: str = "number", hours: int = 24) -> DataFrame:
    """One row of data-quality measures of an enriched table; it need not know the recurrences.

    Rows are reduced to one summary per (interface, family, hour): counts, first and last
    time, and whether the first incident is an intermittent one. In an hour all but the
    first recur; the first does when the nearest earlier hour ends near enough. So only
    summaries are ordered, never incidents.
    """

    def ones(flag: Column) -> Column:
        return F.sum(F.coalesce(flag, F.lit(False)).cast("bigint"))

    intermittent = F.coalesce(F.col("is_intermittent"), F.lit(False))
    hour = df.groupBy(*KEYS, time_slice(F.col(ts)).alias("_slice")).agg(
        F.count(F.lit(1)).alias("n"),
        ones(F.col("primary_interface").isNull()).alias("bare"),
        ones(F.col("error_family") == P.OTHER).alias("other"),
        F.count("stuck_files_count").alias("files"),
        F.count("stuck_for_minutes").alias("minutes"),
        ones(intermittent).alias("glitches"),
        F.min(F.struct(ts, order, intermittent.alias("glitch"))).alias("first"),
        F.max(ts).alias("last"),
    )
    before = F.lag("last").over(W.partitionBy(*KEYS).orderBy("_slice"))
    keyed = F.col("_slice").isNotNull() & F.col(KEYS[0]).isNotNull() & F.col(KEYS[1]).isNotNull()
    near = F.coalesce(within_hours(F.col(f"first.{ts}"), before, hours), F.lit(False))
    alone = F.col("first.glitch") & ~near
    recurring = F.when(keyed, F.col("glitches") - alone.cast("bigint")).otherwise(0)
    total, glitches = F.sum("n"), F.sum("glitches")
    return hour.withColumn("recurring", recurring).agg(
        F.coalesce(F.try_divide(F.sum("bare"), total), F.lit(0.0)).alias("pct_no_interface"),
        F.coalesce(F.try_divide(F.sum("other"), total), F.lit(0.0)).alias("pct_other_error_family"),
        F.coalesce(F.sum("files"), F.lit(0)).alias("rows_with_stuck_files_count"),
        F.coalesce(F.sum("minutes"), F.lit(0)).alias("rows_with_stuck_for_minutes"),
        F.coalesce(F.try_divide(F.sum("recurring"), glitches), F.lit(0.0)).alias("intermittent_with_recurrence_ratio"),
    )


def monthly_trend(df: DataFrame) -> DataFrame:
    return df.groupBy("month").agg(F.count("number").alias("count")).orderBy("month")


def dow_counts(df: DataFrame) -> DataFrame:
    """Tickets per weekday, Monday first; a day without tickets has a NULL count."""
    counted = df.groupBy("dow").agg(F.count("number").alias("count"))
    days = constant_table(df, "dow", P.WEEKDAYS)
    return days.join(counted, "dow", "left").orderBy("position").select("dow", "count")


def dow_hour_matrix(df: DataFrame, absent_days_null: bool = False) -> DataFrame:
    """Weekday x hour counts, columns ``h00`` to ``h23``.

    Empty cells are 0. ``absent_days_null`` leaves a day without any row NULL.
    Cells are counted by (day, hour) first; the pivot then sees at most 168 rows.
    """
    cells = df.groupBy("dow", "hour").agg(F.count(F.lit(1)).alias("n"))
    hours = [F.coalesce(F.sum(F.when(F.col("hour") == h, F.col("n"))), F.lit(0)).alias(f"h{h:02d}") for h in range(24)]
    days = constant_table(df, "dow", P.WEEKDAYS)
    out = days.join(cells.groupBy("dow").agg(*hours), "dow", "left").orderBy("position").drop("position")
    return out if absent_days_null else out.fillna(0)


def pareto(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    """Top ``n`` values with the cumulative share of their own total.

    The running total spans at most ``n`` rows.
    """
    top = value_counts(df, key, n).withColumnRenamed(key, "value")
    running = W.orderBy(F.col("count").desc(), "value").rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    cum = F.sum("count").over(running) / F.sum("count").over(whole) * 100.0
    return top.withColumn("cum_pct", cum)


def extract_stats(df: DataFrame) -> DataFrame:
    """``metric, value`` rows: how many rows and which share has each field."""
    one = df.agg(
        F.count(F.lit(1)).cast("double").alias("rows_total"),
        _share(F.col("primary_interface").isNotNull()).alias("pct_rows_with_primary_interface"),
        _share(F.col("error_codes").isNotNull()).alias("pct_rows_with_error_codes"),
        _share(F.col("has_path")).alias("pct_rows_with_paths"),
        _share(F.col("interface_chain").isNotNull()).alias("pct_rows_with_interface_chain"),
    )
    return one.unpivot([], one.columns, "metric", "value")


def by_error_family(features: DataFrame, per_sheet: bool = False) -> DataFrame:
    """Rows per extracted family (blank left out), optionally per sheet."""
    keys = (["source_sheet"] if per_sheet else []) + ["error_family"]
    named = features.withColumn("error_family", F.nullif(F.col("error_family_extracted"), F.lit("")))
    return value_counts(named, keys)


def by_triplet(features: DataFrame, per_sheet: bool = False) -> DataFrame:
    """Rows per route label (blank left out), optionally per sheet."""
    keys = (["source_sheet"] if per_sheet else []) + ["triplet"]
    label = triplet_label(F.col("src_interface"), F.col("route_or_mid"), F.col("dst_interface"))
    return value_counts(features.withColumn("triplet", F.nullif(label, F.lit(""))), keys)


def histograms(df: DataFrame, cols: Sequence[str], bins: int = 30) -> DataFrame:
    """As :func:`histogram` for several columns at once, told apart by ``metric``.

    The columns are turned into rows, so what they are derived from is computed once;
    values are counted before their limits are sought.
    """
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "metric", "v")
    counts = rows.groupBy("metric", "v").agg(F.count("v").alias("n")).where(F.col("n") > 0)
    limits = counts.groupBy("metric").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))  # one row per column named
    width = (F.col("hi") - F.col("lo")) / bins
    index = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(bins - 1)))
    placed = counts.join(F.broadcast(limits), "metric").withColumn("bin", F.coalesce(index, F.lit(0)).cast("bigint"))
    counted = placed.groupBy("metric", "bin", "lo", width.alias("width")).agg(F.sum("n").alias("count"))
    edges = [(F.col("lo") + (F.col("bin") + k) * F.col("width")).alias(name) for k, name in ((0, "lower"), (1, "upper"))]
    return counted.select("bin", *edges, "count", "metric").orderBy("metric", "bin")


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between minimum and maximum: ``bin, lower, upper, count``; empty bins left out.

    Distinct values are counted first, so the limits come from the small table
    of counts and the rows are read once. The last bin includes the maximum.
    """
    counts = df.groupBy(col).agg(F.count(col).alias("n")).where(F.col("n") > 0)
    lo = counts.agg(F.min(col).cast("double")).scalar()
    hi = counts.agg(F.max(col).cast("double")).scalar()
    ranged = counts.select(F.col(col).cast("double").alias("v"), "n", lo.alias("lo"), hi.alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    index = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(bins - 1)))
    return (
        ranged.select(F.coalesce(index, F.lit(0)).cast("bigint").alias("bin"), "lo", width.alias("width"), "n")
        .groupBy("bin", "lo", "width")
        .agg(F.sum("n").alias("count"))
        .select(
            "bin",
            (F.col("lo") + F.col("bin") * F.col("width")).alias("lower"),
            (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("upper"),
            "count",
        )
        .orderBy("bin")
    )
