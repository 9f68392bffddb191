"""Enrichment: grains, status, text fields, closure notes, CI taxonomy, recurrence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions.times import add_time_grains, opened_time
from ..sources.readers import CI_HEADINGS
from ..sources.schema import normalize_schema, trim_strings
from .fields import extract_fields
from .recurrence import add_recurrence

CI_ATTRIBUTES = tuple(h.lower() for h in CI_HEADINGS[1:])


def with_opened_dt(df: DataFrame, opened: str = "opened", formats: Sequence[str] = ()) -> DataFrame:
    """Append ``opened_dt``; rows whose opening time cannot be read are dropped (count them with :func:`unread_opened`)."""
    return df.withColumn("opened_dt", opened_time(df, opened, formats)).where(F.col("opened_dt").isNotNull())


def unread_opened(df: DataFrame, opened: str = "opened", formats: Sequence[str] = ()) -> DataFrame:
    """One row: ``rows``, and ``unread`` and ``missing`` ones that :func:`with_opened_dt` drops."""
    unread = opened_time(df, opened, formats).isNull()
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(unread & F.col(opened).isNotNull()).alias("unread"),
        F.count_if(F.col(opened).isNull()).alias("missing"),
    )


def last_per_ci(lookup: DataFrame) -> DataFrame:
    """One row per CI; of duplicates the last line wins, so ``line_no`` must be there."""
    if "line_no" not in lookup.columns:
        raise ValueError("the ci lookup needs line_no: of duplicate keys the last line wins")
    record = F.struct(F.col("line_no").alias("_order"), *CI_ATTRIBUTES)
    return (
        lookup.where(F.col("ci").isNotNull())
        .groupBy("ci")
        .agg(F.max(record).alias("_last"))
        .select("ci", *[F.col(f"_last.{a}").alias(a) for a in CI_ATTRIBUTES])
    )


def join_ci(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Left join of the CI taxonomy on ``configuration_item``; adds ``ci`` and its attributes.

    No broadcast hint: Spark broadcasts the lookup when its size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where the
    adaptive skew join splits a dominant CI.
    """
    table = last_per_ci(lookup).withColumnRenamed("ci", "_ci")
    return (
        df.withColumn("ci", F.col("configuration_item"))
        .join(table, F.col("ci") == F.col("_ci"), "left")
        .drop("_ci")
    )


def add_closure_notes(df: DataFrame) -> DataFrame:
    """Append ``is_intermittent`` and ``closure_quality_score`` from the resolution notes."""
    notes = F.col("resolution_notes")
    return df.withColumns(
        {"is_intermittent": X.is_intermittent(notes), "closure_quality_score": X.closure_quality(notes)}
    )


def enrich_rows(
    df: DataFrame,
    text_col: str = "description",
    profile: str = "v1",
    opened: str = "opened",
    formats: Sequence[str] = (),
) -> DataFrame:
    """The row-local part of :func:`enrich`: no join, no window, no shuffle."""
    out = trim_strings(normalize_schema(df))
    out = add_time_grains(with_opened_dt(out, opened, formats), "opened_dt")
    out = out.withColumn("status_canonical", X.canonical_status(F.col("status")))
    return add_closure_notes(extract_fields(out, text_col, profile))


def enrich(
    df: DataFrame,
    ci_lookup: DataFrame | None = None,
    text_col: str = "description",
    profile: str = "v1",
    opened: str = "opened",
    formats: Sequence[str] = (),
) -> DataFrame:
    """Full enrichment of an incident table: one scan, nothing written, only the columns used later are shuffled."""
    out = enrich_rows(df, text_col, profile, opened, formats)
    if ci_lookup is None:
        out = out.withColumn("ci", F.col("configuration_item")).withColumns(
            {a: F.lit(None).cast("string") for a in CI_ATTRIBUTES}
        )
    else:
        out = join_ci(out, ci_lookup)
    return add_recurrence(out, "opened_dt")
