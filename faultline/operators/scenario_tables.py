"""Aggregates of each scenario, over the tall table (one row per incident and scenario)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..sources.sinks import write_table
from .common import explode_list, unknown, value_counts

COUNT = "incidents_count"


def of(tall: DataFrame, *scenarios: str) -> DataFrame:
    return tall.where(F.col("scenario").isin(*scenarios))


def _interfaces(tall: DataFrame, *scenarios: str) -> DataFrame:
    return value_counts(of(tall, *scenarios), "primary_interface", None, P.UNKNOWN, COUNT)


def _paths(tall: DataFrame, scenario: str) -> DataFrame:
    """Mentions per path; a path repeated inside one incident counts each time."""
    return value_counts(explode_list(of(tall, scenario)), "path", count=COUNT)


def _hosts(tall: DataFrame, *scenarios: str) -> DataFrame:
    """Rows per host tag; empty when the table has no host column."""
    if "host_tag" not in tall.columns:
        return tall.sparkSession.createDataFrame([], f"host_tag string, {COUNT} bigint")
    return value_counts(of(tall, *scenarios), "host_tag", None, P.UNKNOWN, COUNT)


# --- stuck files -------------------------------------------------------------


def stuck_paths_counts(tall: DataFrame) -> DataFrame:
    return _paths(tall, "stuck-files")


def stuck_paths_stats(tall: DataFrame) -> DataFrame:
    """Per path: mentions, stuck files, and the spread of minutes.

    The metrics ride along through the explode, so nothing is joined back. Mentions
    are counted per path and minutes first, by a hash aggregate; the exact median
    then takes each number of minutes once, with its weight.
    """
    minutes, n = F.col("minutes"), F.col("n")
    known = F.when(minutes.isNotNull(), n)
    return (
        explode_list(of(tall, "stuck-files"))
        .groupBy("path", F.col("stuck_for_minutes").cast("double").alias("minutes"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("stuck_files_count", F.lit(0))).alias("files"))
        .groupBy("path")
        .agg(
            F.sum(n).alias(COUNT),
            F.sum("files").cast("double").alias("total_stuck_files"),
            (F.sum(minutes * n) / F.sum(known)).alias("mean_minutes"),
            F.percentile(minutes, 0.5, n).alias("median_minutes"),
            F.min(minutes).alias("min_minutes"),
            F.max(minutes).alias("max_minutes"),
        )
        .orderBy(F.col(COUNT).desc(), "path")
    )


def stuck_top_interfaces(tall: DataFrame) -> DataFrame:
    return (
        of(tall, "stuck-files")
        .select(unknown("primary_interface"), "stuck_files_count")
        .groupBy("primary_interface")
        .agg(
            F.count(F.lit(1)).alias(COUNT),
            F.sum(F.coalesce("stuck_files_count", F.lit(0))).cast("double").alias("total_stuck_files"),
        )
        .orderBy(F.col(COUNT).desc(), "primary_interface")
    )


# --- transfer errors ---------------------------------------------------------


def ftp_by_verb(tall: DataFrame) -> DataFrame:
    return value_counts(of(tall, "ftp-errors"), "ftp_command", None, P.UNKNOWN, COUNT)


def ftp_by_code(tall: DataFrame) -> DataFrame:
    return value_counts(of(tall, "ftp-errors"), "ftp_code", None, P.UNKNOWN, COUNT)


def ftp_iface_verb_code(tall: DataFrame) -> DataFrame:
    keys = ["primary_interface", "ftp_command", "ftp_code"]
    return value_counts(of(tall, "ftp-errors"), keys, None, P.UNKNOWN, COUNT)


def ftp_tables(tall: DataFrame) -> DataFrame:
    """The three transfer tables in one pass, told apart by ``table``."""
    base = of(tall, "ftp-errors").select(
        unknown("primary_interface"), unknown("ftp_command"), unknown("ftp_code")
    )
    i, v, c = (F.col(x) for x in ("primary_interface", "ftp_command", "ftp_code"))
    level = F.grouping_id(i, v, c)
    name = F.when(level == 5, "by_verb").when(level == 6, "by_code").otherwise("by_interface_verb_code")
    return base.groupingSets([[v], [c], [i, v, c]], i, v, c).agg(
        name.alias("table"), F.count(F.lit(1)).alias(COUNT)
    )


def ftp_permission_connectivity(tall: DataFrame) -> DataFrame:
    """Permission and connectivity hits per interface."""

    def hits(flag: str):
        return F.sum(F.coalesce(F.col(flag), F.lit(False)).cast("bigint")).alias(flag)

    return (
        of(tall, "ftp-errors")
        .select(unknown("primary_interface"), "permission_denied", "not_connected")
        .groupBy("primary_interface")
        .agg(hits("permission_denied"), hits("not_connected"), F.count(F.lit(1)).alias(COUNT))
        .orderBy(F.col(COUNT).desc(), "primary_interface")
    )


def perm_conn_melt(permission_connectivity: DataFrame) -> DataFrame:
    """The two flag counts as ``category, count`` rows."""
    return permission_connectivity.unpivot(
        ["primary_interface", COUNT], ["permission_denied", "not_connected"], "category", "count"
    )


# --- the other scenarios -----------------------------------------------------


def config_bad_paths(tall: DataFrame, root: str = P.CONFIG_ROOT) -> DataFrame:
    exploded = explode_list(of(tall, "config-file"))
    return value_counts(exploded.where(F.col("path").startswith(root)), "path", count=COUNT)


def config_top_interfaces(tall: DataFrame) -> DataFrame:
    return _interfaces(tall, "config-file")


def err_remove_by_interface(tall: DataFrame) -> DataFrame:
    return _interfaces(tall, "err-file-remove")


def err_remove_paths(tall: DataFrame) -> DataFrame:
    return _paths(tall, "err-file-remove")


def process_alert_by_interface(tall: DataFrame) -> DataFrame:
    return _interfaces(tall, "process-alert")


def process_alert_time(tall: DataFrame) -> DataFrame:
    """Rows with an interface per month; unreadable dates form the NULL month."""
    return (
        of(tall, "process-alert")
        .groupBy("month")
        .agg(F.count("primary_interface").alias(COUNT))
        .orderBy("month")
    )


_CALLOUTS = ("callout_mfterr03", "callout_mfterr04")


def callout_interfaces(tall: DataFrame, scenario: str | None = None) -> DataFrame:
    """Interfaces of one callout scenario, or of each with a ``scenario`` column."""
    if scenario is not None:
        return _interfaces(tall, scenario)
    return value_counts(of(tall, *_CALLOUTS), ["scenario", "primary_interface"], None, P.UNKNOWN, COUNT)


def callout_hosts(tall: DataFrame, scenario: str | None = None) -> DataFrame:
    """Hosts of one callout scenario, or of each with a ``scenario`` column."""
    if scenario is not None or "host_tag" not in tall.columns:
        return _hosts(tall, *((scenario,) if scenario else _CALLOUTS))
    return value_counts(of(tall, *_CALLOUTS), ["scenario", "host_tag"], None, P.UNKNOWN, COUNT)


def warnings_hosts(tall: DataFrame) -> DataFrame:
    return _hosts(tall, "warnings")


def warnings_fs_paths(tall: DataFrame) -> DataFrame:
    return _paths(tall, "warnings")


def misc_error_codes(tall: DataFrame) -> DataFrame:
    return value_counts(explode_list(of(tall, "misc"), "error_codes", "error_code"), "error_code")


def misc_top_tokens(tall: DataFrame, n: int = 200) -> DataFrame:
    words = F.regexp_extract_all(F.col("short_description"), F.lit(P.WORD_TOKEN), F.lit(0))
    tokens = of(tall, "misc").select(F.explode_outer(words).alias("token")).select(F.lower("token").alias("token"))
    return value_counts(tokens, "token", n)


def subgroup_counts(tall: DataFrame) -> DataFrame:
    """Rows per sub-partition: stuck files by interface, transfer errors by verb and by code."""
    kinds = {
        ("stuck-files", "primary_interface"): "by-interface",
        ("ftp-errors", "ftp_command"): "by-verb",
        ("ftp-errors", "ftp_code"): "by-code",
    }
    cells = F.array(
        *[
            F.when(
                F.col("scenario") == s,
                F.struct(F.lit(kind).alias("kind"), F.coalesce(F.col(k), F.lit(P.UNKNOWN)).alias("value")),
            )
            for (s, k), kind in kinds.items()
        ]
    )
    return (
        of(tall, "stuck-files", "ftp-errors")
        .select("scenario", F.inline(F.array_compact(cells)))
        .groupBy("scenario", "kind", "value")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("scenario", "kind", F.col("count").desc(), "value")
    )


# --- whole run ---------------------------------------------------------------


def top_offenders(tall: DataFrame, n: int = 10) -> DataFrame:
    """Interfaces by rows over all groups; an incident counts once per group."""
    return value_counts(tall, "primary_interface", n, P.UNKNOWN, COUNT)


def run_summary(tall: DataFrame) -> DataFrame:
    """One row: totals, coverage, a count per group and quality measures.

    Rows are counted once per group, as in the group tables. One aggregate; the
    group counts are conditional sums returned as a map.
    """
    rows = F.count(F.lit(1))
    per_group = [F.sum((F.col("scenario") == s).cast("bigint")).alias(f"n_{s}") for s in P.SCENARIOS]
    missing = F.avg(F.col("primary_interface").isNull().cast("int"))
    other = F.avg(F.coalesce(F.lower("error_family") == P.OTHER, F.lit(False)).cast("int"))
    one = tall.agg(
        rows.alias("total_rows"),
        *per_group,
        F.coalesce(missing, F.lit(0.0)).alias("pct_missing_primary_interface"),
        F.coalesce(other, F.lit(0.0)).alias("pct_error_family_other"),
        (F.count("stuck_files_count") + F.count("stuck_for_minutes")).alias("rows_with_stuck_metrics"),
        (F.count("ftp_command") + F.count("ftp_code")).alias("rows_with_ftp_metadata"),
    )
    counts = F.create_map(
        *[x for s in P.SCENARIOS for x in (F.lit(s), F.coalesce(F.col(f"`n_{s}`"), F.lit(0)))]
    )
    covered = F.col("total_rows") - F.coalesce(F.col("n_misc"), F.lit(0))
    pct = F.when(F.col("total_rows") > 0, covered / F.col("total_rows") * 100.0).otherwise(0.0)
    return one.select(
        "total_rows",
        covered.alias("coverage_non_misc"),
        pct.alias("coverage_pct"),
        counts.alias("group_counts"),
        "pct_missing_primary_interface",
        "pct_error_family_other",
        "rows_with_stuck_metrics",
        "rows_with_ftp_metadata",
    )


def summary_json(tall: DataFrame, n: int = 10) -> DataFrame:
    """The run summary and its top offenders as one JSON document.

    At most ``n`` offender rows are gathered.
    """
    offenders = top_offenders(tall, n).agg(
        F.array_sort(
            F.collect_list(F.struct((-F.col(COUNT)).alias("order"), "primary_interface", COUNT))
        ).alias("items")
    )
    listed = offenders.select(
        F.transform(
            "items", lambda x: F.struct(x["primary_interface"].alias("primary_interface"), x[COUNT].alias(COUNT))
        )
    )
    document = run_summary(tall).select("*", listed.scalar().alias("top_offenders_interfaces"))
    return document.select(F.to_json(F.struct("*")).alias("summary"))


#: Tables of a whole run, by name; each reads only the scenarios it needs.
RUN_TABLES = {
    table.__name__: table
    for table in (
        stuck_paths_counts, stuck_paths_stats, stuck_top_interfaces, ftp_by_verb, ftp_by_code, ftp_iface_verb_code,
        ftp_permission_connectivity, config_bad_paths, config_top_interfaces, err_remove_by_interface, err_remove_paths,
        process_alert_by_interface, process_alert_time, callout_interfaces, callout_hosts, warnings_hosts, warnings_fs_paths,
        misc_error_codes, misc_top_tokens, subgroup_counts, top_offenders, summary_json,
    )
}


def write_run_tables(run: DataFrame, path: str, fmt: str = "parquet") -> list[str]:
    """Every table of a stored run, one folder each below ``path``; returns their names.

    Each table scans only its scenarios' folders and columns of the run, so the
    texts are never extracted again. A CSV table needs plain columns only.
    """
    for name, table in RUN_TABLES.items():
        write_table(table(run), f"{path}/{name}", fmt)
    return list(RUN_TABLES)
