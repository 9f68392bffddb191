"""Registered queries: one per operator, each over whole tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose list
columns are joined text and whose timestamps are text, so that results compare
as plain values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions import families, times
from ..functions.text import join_list, join_or_null, pool_text, prefer_text, text_or_empty
from ..operators import enrich as E
from ..operators import fields, filters, rollups, scenarios, unique_paths
from ..operators import scenario_tables as S
from ..operators.common import explode_list, value_counts
from ..operators.recurrence import add_recurrence, recurrence_pairs
from ..session import new_table_path, written
from ..sources import readers, schema, sinks
from .fixtures import ci_lookup, incidents, texts

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}



def sd() -> Column:
    return F.col("short_description")


def desc() -> Column:
    return F.col("description")



def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = fn
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- shared inputs -----------------------------------------------------------


def enriched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.enrich_rows(incidents(spark, sf_dir), opened="opened_raw")


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.enrich(incidents(spark, sf_dir), ci_lookup(spark, sf_dir), opened="opened_raw")


# Site values of the test projection.
HOST_PREFIX = "abc"
HOST_DOMAIN = "example.net"


def helped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents with v2 helpers, host tag and time grains (all rows kept)."""
    df = incidents(spark, sf_dir)
    out = fields.ensure_helpers(df).withColumn("host_tag", X.host_tag(sd(), HOST_PREFIX))
    return times.add_time_grains(out.withColumn("opened_dt", times.parse_opened(F.col("opened_raw"))))


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenarios.tag_scenarios(helped(spark, sf_dir))


def tall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenarios.scenario_tall(tagged(spark, sf_dir))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tall table with one run per opening month."""
    month = F.substring(F.col("opened").cast("string"), 1, 7)
    return tall(spark, sf_dir).withColumn("run_id", F.concat(F.lit("run_"), month))


def path_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents with the primary interface of the short text; families still to be derived."""
    return incidents(spark, sf_dir).withColumn("primary_interface", X.primary_interface(X.interface_ids(sd())))


def path_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique_paths.unique_paths(path_input(spark, sf_dir), description_only=False)


def per_row(columns: Callable[[], Sequence[Column]]) -> Query:
    """Ticket number and computed columns; built on call, when a session exists."""
    return lambda spark, sf_dir: incidents(spark, sf_dir).select("number", *columns())


def per_text(columns: Callable[[], Sequence[Column]]) -> Query:
    """Like :func:`per_row`, over whole real texts."""
    return lambda spark, sf_dir: texts(spark, sf_dir).select("number", *columns())


def over(source: Query, fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(source(spark, sf_dir))


# --- sources and sinks -------------------------------------------------------


@query("scan_csv")
def _(spark, sf_dir):
    """Two folders of parts with other headings, order and columns, read as one by heading."""
    columns = ["number", "opened_raw", "caller", "short_description", "description", "resolution_notes"]
    path = new_table_path(spark, "incidents-csv")
    df = incidents(spark, sf_dir)
    even = F.substring("number", -1, 1).cast("int") % 2 == 0
    headings = {"short_description": "Short description", "caller": " CALLER ", "resolution_notes": "Resolution Notes"}
    sinks.write_table(df.where(even).select(*columns, "status"), f"{path}/a", "csv")
    other = df.where(~even).select(*reversed(columns)).withColumnsRenamed(headings)
    sinks.write_table(other, f"{path}/b", "csv")
    return readers.read_incidents(spark, f"{path}/*", fmt="csv").select(*columns)


@query("sheet_select")
def _(spark, sf_dir):
    return readers.select_sheet(incidents(spark, sf_dir), "sheet1").select("number", "source_sheet")


@query("sheet_union")
def _(spark, sf_dir):
    df = incidents(spark, sf_dir)
    columns = {
        "sheet0": ["number", "status"],
        "sheet1": ["number", "status", "comments"],
        "sheet2": ["comments", "number"],
    }
    sheets = {s: df.where(F.col("source_sheet") == s).select(*cols) for s, cols in columns.items()}
    return readers.union_sheets(sheets).select("number", "status", "comments", "source_sheet")


query("per_sheet_rollup")(
    lambda spark, sf_dir: rollups.by_error_family(
        fields.extract_features(incidents(spark, sf_dir), "v3"), per_sheet=True
    )
)


@query("lexicon_load")
def _(spark, sf_dir):
    names = incidents(spark, sf_dir).select(
        F.explode(F.array(F.concat(F.lit("  "), F.col("category"), F.lit("\t")), F.lit("  "))).alias("value")
    )
    path = new_table_path(spark, "lexicon")
    names.distinct().orderBy(F.col("value").desc()).write.text(path)
    return readers.lexicon_positions(readers.read_lexicon(spark, path))


@query("ci_lookup_scan")
def _(spark, sf_dir):
    """Every ticket's CI as a lookup line, then what the tickets of each CI say together; the later folder's lines win."""
    path = new_table_path(spark, "ci-lookup")
    tickets = incidents(spark, sf_dir).where(F.col("configuration_item").isNotNull())
    facts = {
        "CI_role": F.max("severity"), "CI_protocol": F.min("category"), "CI_env": F.max("source_sheet"),
        "CI_techstack": F.min("assignment_group"), "CI_criticality": F.count(F.lit(1)).cast("string"),
    }
    titled = tickets.groupBy(F.col("configuration_item").alias("CI")).agg(*[c.alias(h) for h, c in facts.items()])
    old = [F.lit(f"old {h}").alias(h.upper()) for h in reversed(facts)]
    sinks.write_table(tickets.select(*old, F.col("configuration_item").alias(" ci")), f"{path}/a", "csv")
    sinks.write_table(titled, f"{path}/b", "csv")
    return E.last_per_ci(readers.read_ci_lookup(spark, f"{path}/*"))


@query("read_group")
def _(spark, sf_dir):
    path = new_table_path(spark, "run")
    sinks.write_run(runs(spark, sf_dir), path)
    newest = readers.run_names(spark, path)[0]
    return readers.read_group(spark, path, newest, "callout/mfterr03").select("number", "run_id", "scenario")


def stored_runs(spark: SparkSession, sf_dir: str) -> str:
    path = new_table_path(spark, "run")
    sinks.write_run(runs(spark, sf_dir), path)
    return path


@query("latest_run")
def _(spark, sf_dir):
    return readers.read_run(spark, stored_runs(spark, sf_dir)).select("number", "run_id", "scenario")


def stored_tall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows as one stored run."""
    path = new_table_path(spark, "run")
    sinks.write_run(tall(spark, sf_dir), path, "all")
    return readers.read_run(spark, path, "all")


for _name in ("stuck_paths_stats", "ftp_iface_verb_code", "misc_top_tokens", "top_offenders"):
    query(f"stored_{_name}")(over(stored_tall, getattr(S, _name)))
query("summary_read")(lambda spark, sf_dir: readers.read_summary(scenarios.partition_summary(tagged(spark, sf_dir))))


@query("unique_paths_read")
def _(spark, sf_dir):
    path = new_table_path(spark, "unique-paths")
    table = path_table(spark, sf_dir).select(*[f.name for f in readers.UNIQUE_PATHS_SCHEMA])
    sinks.write_table(table, path, "csv")
    return readers.read_unique_paths(spark, path, fmt="csv")


@query("sink_roundtrip")
def _(spark, sf_dir):
    path = new_table_path(spark, "enriched")
    columns = ["number", "opened_dt", "primary_interface", "error_family", "stuck_for_minutes", "source_sheet"]
    sinks.write_table(enriched_rows(spark, sf_dir).select(*columns), path, partition_by=("source_sheet",))
    back = spark.read.parquet(path)
    return back.withColumn("opened_dt", F.col("opened_dt").cast("string"))


@query("scenario_sink")
def _(spark, sf_dir):
    """A run written twice; the first time it had more rows, of which nothing may stay."""
    path = new_table_path(spark, "run")
    whole = written(runs(spark, sf_dir), "tall-runs")  # the texts are searched once, not for each write
    sinks.write_run(whole.unionByName(whole.withColumn("scenario", F.lit("gone"))), path)
    sinks.write_run(whole, path)
    return spark.read.parquet(path).groupBy("run_id", "scenario").agg(F.count(F.lit(1)).alias("count"))


@query("subgroup_sink")
def _(spark, sf_dir):
    path = new_table_path(spark, "subgroups")
    sinks.write_subgroups(tall(spark, sf_dir), path, "stuck-files", "primary_interface")
    back = spark.read.parquet(path)
    return back.groupBy("by_primary_interface").agg(F.count(F.lit(1)).alias("count"))


query("subgroup_counts")(over(tall, S.subgroup_counts))
query("misc_samples")(
    over(tagged, lambda df: scenarios.misc_samples(df).select("number", "short_description"))
)

# --- projection and schema shaping -------------------------------------------


@query("schema_normalize")
def _(spark, sf_dir):
    df = incidents(spark, sf_dir).drop("configuration_item", "comments", "opened_raw", "source_sheet")
    shouted = df.withColumnsRenamed({n: f" {h.upper()} " for h, n in schema.INCIDENT_COLUMNS.items()})
    out = schema.normalize_schema(shouted)
    return out.select("number", "caller", "assigned_to", "assignment_group", "configuration_item", "comments")


query("trim_strings")(
    over(incidents, lambda df: schema.trim_strings(df).select("number", "status", "short_description", "caller"))
)
query("shortdesc_extract")(
    over(incidents, lambda df: fields.shortdesc_extract(df, raw_chain=True, host_prefix=HOST_PREFIX).withColumn("opened", F.col("opened").cast("string")))
)
query("desc_features")(
    over(
        incidents,
        lambda df: fields.extract_features(df, "v3", domain=HOST_DOMAIN).select("number", *fields.FEATURE_COLUMNS),
    )
)
query("desc_features_only")(over(incidents, lambda df: fields.extract_features(df, "v3", append_only=True, domain=HOST_DOMAIN)))
query("shortdesc_features")(
    over(
        incidents,
        lambda df: fields.extract_features(df, "v4").select("number", *fields.FEATURE_COLUMNS[:-1]),
    )
)


def _with_some_helpers(df: DataFrame) -> DataFrame:
    """Incidents where some helper values are already given."""
    return df.withColumns(
        {
            "error_family": F.when(F.col("severity") == "1", F.lit("GIVEN")),
            "stuck_files_count": F.when(F.col("severity") == "2", F.lit(7).cast("bigint")),
        }
    )


_HELPERS = ("number", *fields.HELPER_TYPES)
query("ensure_helpers")(over(incidents, lambda df: fields.ensure_helpers(_with_some_helpers(df)).select(*_HELPERS)))
query("ensure_helpers_default")(
    over(incidents, lambda df: fields.ensure_helpers(_with_some_helpers(df), derive=False).select(*_HELPERS))
)
query("text_pool")(per_row(lambda: [pool_text(sd(), F.col("resolution_notes"), desc(), F.col("comments")).alias("text")]))
query("text_prefer")(per_row(lambda: [prefer_text(desc(), sd()).alias("text")]))
query("perm_conn_melt")(over(tall, lambda df: S.perm_conn_melt(S.ftp_permission_connectivity(df))))
query("explode_paths")(over(helped, lambda df: explode_list(df).select("number", "path")))
query("paths_cell_split")(
    per_row(lambda: [join_list(X.split_paths(sd()), " | ").alias("parts"), F.size(X.split_paths(sd())).cast("bigint").alias("n")])
)
query("filter_options")(over(helped, filters.filter_options))
query("ci_choices")(over(path_table, filters.joined_choices))

# --- text extraction ---------------------------------------------------------


def _ids() -> Column:
    return X.interface_ids(sd())


query("interfaces")(per_row(lambda: [join_or_null(_ids()).alias("interfaces")]))
query("primary_interface")(per_row(lambda: [X.primary_interface(_ids()).alias("primary_interface")]))
query("interface_count")(per_row(lambda: [F.size(_ids()).cast("bigint").alias("interface_count")]))
query("interface_chain")(per_row(lambda: [X.chain_clean(sd(), _ids()).alias("interface_chain")]))
query("interface_chain_raw")(per_row(lambda: [X.chain_raw(sd()).alias("interface_chain_raw")]))
query("triplet")(per_row(lambda: [*[c.alias(n) for n, c in X.triplet(desc()).items()]]))
query("error_codes")(per_row(lambda: [join_or_null(X.error_codes(sd())).alias("error_codes")]))
query("error_family_lexicon")(
    per_row(lambda: [
        families.family_v1(text_or_empty(desc())).alias("error_family"),
        families.family_v1(text_or_empty(sd())).alias("error_family_short"),])
)
query("error_family_v2")(per_row(lambda: [families.fixed_family(sd(), "v2").alias("error_family")]))
query("error_family_v3")(per_row(lambda: [families.fixed_family(prefer_text(desc(), sd()), "v3").alias("error_family")]))
query("error_family_v4")(per_row(lambda: [families.fixed_family(fields.feature_text("v4"), "v4").alias("error_family")]))


def _rederive(df: DataFrame, force: bool) -> DataFrame:
    lexicon = ("FMS-ERR-FILE-COPY", "Address already in use", "MISSING FILES")
    given = df.withColumn(
        "error_family", F.when(F.col("severity") == "1", "GIVEN").when(F.col("severity") == "2", " ")
    )
    return unique_paths.rederive_family(given, lexicon, force=force).select("number", "error_family")


query("family_rederive")(over(incidents, lambda df: _rederive(df, force=False)))
query("family_rederive_forced")(over(incidents, lambda df: _rederive(df, force=True)))
query("anomalies")(
    per_row(lambda: [
        join_or_null(families.unmatched_anomalies(text_or_empty(sd()), families.family_v1(text_or_empty(sd()))), "; ").alias(
            "anomalies"
        )])
)
query("paths_rooted")(
    per_row(lambda: [
        join_or_null(X.paths_rooted(sd(), "v1"), " ").alias("paths_v1"),
        join_or_null(X.paths_rooted(sd(), "v2"), " ").alias("paths_v2"),
        (F.size(X.paths_rooted(sd(), "v2")) > 0).alias("has_path"),])
)


def _pool() -> Column:
    return pool_text(sd(), desc(), F.col("resolution_notes"), F.col("comments"))


query("paths_general")(
    per_row(lambda: [
        join_list(X.text_paths(_pool())).alias("paths_v5"),
        join_list(X.feature_paths(_pool())).alias("paths_v3"),])
)
query("normalize_path")(per_row(lambda: [X.normalize_path(sd()).alias("path")]))
query("paths_absolute")(per_row(lambda: [join_list(X.absolute_only(F.split(text_or_empty(sd()), " "))).alias("absolute_words")]))
query("paths_fallback")(
    per_row(lambda: [
        join_list(X.text_paths(sd(), allow_non_abs=True)).alias("tokens_v5"),
        join_list(X.feature_paths(sd(), allow_non_abs=True)).alias("tokens_v3"),])
)
query("file_patterns")(
    per_row(lambda: [
        join_list(X.file_patterns(sd(), "v3")).alias("patterns_v3"),
        join_list(X.file_patterns(sd(), "v4")).alias("patterns_v4"),])
)
query("stuck_metrics")(
    per_row(lambda: [
        X.stuck_count(sd(), "v2").alias("stuck_files_count"),
        X.stuck_minutes(sd(), "v2").alias("stuck_for_minutes"),
        X.stuck_count(desc(), "v3").alias("stuck_count"),
        X.stuck_minutes(desc(), "v3").alias("stuck_minutes"),])
)
query("ftp_command")(per_row(lambda: [X.ftp_command(sd()).alias("ftp_command"), X.ftp_code_550(sd()).alias("ftp_code")]))
query("ftp_code_message")(
    per_row(lambda: [
        X.ftp_code(sd()).alias("ftp_code"),
        X.ftp_message(sd()).alias("ftp_message"),
        X.ftp_code(desc()).alias("desc_code"),
        X.ftp_message(desc()).alias("desc_message"),])
)


def _v3_text() -> Column:
    return prefer_text(desc(), sd())


def _v4_text() -> Column:
    return fields.feature_text("v4")


@query("operation_tags")
def _(spark, sf_dir):
    df = incidents(spark, sf_dir)
    return df.select(
        "number",
        join_list(X.operation_tags(_v3_text(), "v3")).alias("tags_v3"),
        join_list(X.operation_tags(_v4_text(), "v4")).alias("tags_v4"),
    )


@query("operation")
def _(spark, sf_dir):
    staged = incidents(spark, sf_dir).select(
        "number",
        _v3_text().alias("text_v3"),
        _v4_text().alias("text_v4"),
        X.operation_tags(_v3_text(), "v3").alias("tags_v3"),
        X.operation_tags(_v4_text(), "v4").alias("tags_v4"),
    )
    columns = []
    for p in ("v3", "v4"):
        tags = F.col(f"tags_{p}")
        columns.append(X.operation(F.col(f"text_{p}"), tags).alias(f"operation_{p}"))
        columns.append(X.operation_success(tags, p).alias(f"success_{p}"))
    return staged.select("number", *columns)


query("hosts")(
    per_row(lambda: [
        join_list(X.app_hosts(_v4_text(), HOST_DOMAIN)).alias("hosts_v3"),
        join_list(X.app_hosts(_v4_text())).alias("hosts_v4"),])
)
query("host_tag")(per_row(lambda: [X.host_tag(sd(), HOST_PREFIX).alias("host_tag")]))
query("script_name")(per_row(lambda: [X.script_name(sd()).alias("script_name")]))
query("warning_subject")(per_row(lambda: [X.warning_subject(sd(), families.fixed_family(sd(), "v2")).alias("warning_subject")]))
query("fms_class")(per_row(lambda: [X.fms_class(desc()).alias("fms_err_class")]))


@query("fired_time")
def _(spark, sf_dir):
    raw = incidents(spark, sf_dir).withColumns(times.raw_times(sd(), "v2"))
    return raw.select("number", *[c.alias(n) for n, c in times.fired_time(F.col("_iso"), F.col("_named")).items()])


@query("extracted_timestamp")
def _(spark, sf_dir):
    df = incidents(spark, sf_dir)
    iso, named = F.col("_iso"), F.col("_named")
    pooled = df.withColumns(times.raw_times(_v4_text(), "v3")).withColumns(
        {
            "timestamp_v3": times.extracted_timestamp(iso, named, F.col("_fired")),
            "timestamp_v4": times.extracted_timestamp(iso, named),
        }
    )
    described = pooled.withColumns(times.raw_times(desc(), "v4"))
    return described.select(
        "number", "timestamp_v3", "timestamp_v4", times.extracted_timestamp(iso, named).alias("timestamp_desc")
    )


query("caller_class")(per_row(lambda: [X.caller_class(F.col("caller")).alias("caller_class")]))
query("status_canonical")(per_row(lambda: [X.canonical_status(F.col("status")).alias("status_canonical")]))
query("closure_quality")(
    per_row(lambda: [
        X.is_intermittent(F.col("resolution_notes")).alias("is_intermittent"),
        X.closure_quality(F.col("resolution_notes")).cast("bigint").alias("closure_quality_score"),])
)
query("perm_conn_flags")(
    per_row(lambda: [X.permission_denied(sd()).alias("permission_denied"), X.not_connected(sd()).alias("not_connected")])
)

# --- time --------------------------------------------------------------------

FORMATS = ("dd/MM/yyyy HH:mm", "MM/dd/yyyy HH:mm", "dd-MMM-yyyy HH:mm", "yyyy/MM/dd")


def _in_formats() -> list[Column]:
    """The opening time written in each format, read back with that format."""
    written = [F.date_format("opened", f) for f in FORMATS]
    return [times.parse_opened(c, [f]).cast("string").alias(f"form_{k}") for k, (c, f) in enumerate(zip(written, FORMATS, strict=True))]


query("opened_formats")(per_row(_in_formats))
query("opened_unread")(over(incidents, lambda df: E.unread_opened(df, "opened_raw")))
query("opened_parse")(per_row(lambda: [times.parse_opened(F.col("opened_raw")).cast("string").alias("opened_dt")]))
query("time_grains")(
    over(
        incidents,
        lambda df: times.add_time_grains(E.with_opened_dt(df, "opened_raw")).select(
            "number", "month", "week", "dow", "hour", "daypart"
        ),
    )
)

# --- filters -----------------------------------------------------------------


def _filtered(**tests) -> Query:
    columns = ["number", "primary_interface", "error_family", "ftp_command", "month", "dow", "hour"]
    return over(helped, lambda df: filters.filter_incidents(df, **tests).select(*columns))


query("filter_exact")(_filtered(family="FMS-FTP-ERROR", ftp_command="put", ftp_code="550"))
query("filter_text")(_filtered(text="e000012"))
query("filter_time")(_filtered(dows=["Monday", "Tuesday"], hours=(8, 17)))
query("filter_paths_global")(
    over(path_table, lambda p: filters.filter_paths(p, family="fms", interface="e0000", text="/opt"))
)
query("filter_paths_specific")(
    over(path_table, lambda p: filters.filter_paths(p, path_prefix="/opt", min_incidents=2, ci_choice="CI-1"))
)
query("basename_filter")(
    over(
        path_table,
        lambda p: filters.filter_paths(p, file_name="E00001").select(
            "path", "incident_count", X.basename(F.col("path")).alias("basename")
        ),
    )
)
query("drill_through")(
    over(helped, lambda df: filters.drill_through(df, "/OPT/big/configs/E00001").select("number", "paths"))
)
query("drill_through_all")(
    lambda spark, sf_dir: filters.drill_through_all(
        helped(spark, sf_dir), written(path_table(spark, sf_dir), "unique-paths")
    )
)
query("preview")(over(incidents, lambda df: filters.preview(df).select("number", "status")))

# --- scenarios ---------------------------------------------------------------

query("scenario_counts")(over(tall, scenarios.scenario_counts))
query("scenario_tall")(over(tall, lambda df: df.select("number", "scenario")))
query("partition_summary")(over(tagged, scenarios.partition_summary))

# --- joins and windows -------------------------------------------------------


@query("ci_join")
def _(spark, sf_dir):
    lookup = ci_lookup(spark, sf_dir)
    repeated = lookup.withColumn("line_no", F.lit(1)).unionByName(
        lookup.where(F.col("ci_env") == "dev").withColumns({"line_no": F.lit(2), "ci_role": F.lit("replaced")})
    )
    joined = E.join_ci(incidents(spark, sf_dir), repeated)
    return joined.select("number", "ci", *E.CI_ATTRIBUTES)


@query("recurrence")
def _(spark, sf_dir):
    out = add_recurrence(enriched_rows(spark, sf_dir))
    return out.select(
        "number",
        "primary_interface",
        "error_family",
        F.col("opened_dt").cast("string").alias("opened_dt"),
        F.col("prev_time").cast("string").alias("prev_time"),
        "recurs_24h",
    )


query("recurrence_pairs")(over(enriched_rows, recurrence_pairs))


def _listed_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique_paths.incident_paths(path_input(spark, sf_dir), description_only=False)


def _with_copies(df: DataFrame) -> DataFrame:
    """Each incident twice; the copy is opened later and has another interface."""
    copy = df.withColumns(
        {"opened": F.timestamp_add("HOUR", F.lit(1), "opened"), "primary_interface": F.lit("E999999")}
    )
    return df.unionByName(copy)


query("path_dedup")(
    over(
        _listed_paths,
        lambda df: unique_paths.path_dedup(_with_copies(df)).select(
            "number", "path", "configuration_item", "primary_interface"
        ),
    )
)
query("path_scan_stats")(over(_listed_paths, unique_paths.path_scan_stats))
query("unique_paths")(path_table)
query("unique_paths_min")(
    over(path_input, lambda df: unique_paths.unique_paths(df, description_only=False, min_count=5))
)
query("unique_paths_fixed")(over(path_input, lambda df: unique_paths.unique_paths_fixed(df, derive=True)))
query("top_paths")(over(path_table, lambda p: filters.top_paths(p).select("path", "incident_count")))

# --- rollups -----------------------------------------------------------------

query("kpis")(over(enriched_rows, rollups.kpis))
query("top_interfaces")(over(enriched_rows, lambda df: value_counts(df, "primary_interface", 15)))
query("top_error_families")(over(enriched_rows, lambda df: value_counts(df, "error_family", 10)))
query("ci_error_pairs")(
    lambda spark, sf_dir: rollups.ci_error_pairs(E.join_ci(enriched_rows(spark, sf_dir), ci_lookup(spark, sf_dir)))
)
query("ci_error_pairs_top")(
    lambda spark, sf_dir: rollups.ci_error_pairs(
        enriched_rows(spark, sf_dir).withColumn("ci", F.col("configuration_item")), 10
    ).select(
        F.concat(F.coalesce("ci", F.lit("(none)")), F.lit(" × "), "error_family").alias("pair"), "count"
    )
)
query("quality_checks")(over(enriched_rows, rollups.quality_checks))
query("monthly_trend")(over(enriched_rows, rollups.monthly_trend))
query("dow_counts")(over(enriched_rows, rollups.dow_counts))
query("dow_hour_matrix")(over(enriched_rows, rollups.dow_hour_matrix))
query("error_family_pareto")(over(enriched_rows, lambda df: rollups.pareto(df, "error_family")))
query("shortdesc_top")(
    over(helped, lambda df: value_counts(df, "primary_interface", 30))
)
query("shortdesc_top_families")(over(helped, lambda df: value_counts(df, "error_family", 30)))
query("shortdesc_stats")(over(incidents, lambda df: rollups.extract_stats(fields.shortdesc_extract(df))))
query("by_error_family")(over(incidents, lambda df: rollups.by_error_family(fields.extract_features(df, "v3"))))
query("by_triplet")(over(incidents, lambda df: rollups.by_triplet(fields.extract_features(df, "v4"))))


@query("by_error_family_all")
def _(spark, sf_dir):
    df = incidents(spark, sf_dir)
    sheets = {s: df.where(F.col("source_sheet") == s).drop("source_sheet") for s in ("sheet0", "sheet1", "sheet2")}
    return rollups.by_error_family(fields.extract_features(readers.union_sheets(sheets), "v4"))


@query("by_triplet_sheets")
def _(spark, sf_dir):
    return rollups.by_triplet(fields.extract_features(incidents(spark, sf_dir), "v3"), per_sheet=True)


@query("stuck_histogram")
def _(spark, sf_dir):
    return rollups.histograms(helped(spark, sf_dir), ("stuck_files_count", "stuck_for_minutes"))


query("filtered_top_interfaces")(
    over(helped, lambda df: value_counts(filters.filter_incidents(df, hours=(6, 18)), "primary_interface", 20))
)

for _name in (
    "stuck_paths_counts", "stuck_paths_stats", "stuck_top_interfaces", "ftp_by_verb", "ftp_by_code",
    "ftp_iface_verb_code", "ftp_tables", "ftp_permission_connectivity", "config_bad_paths",
    "config_top_interfaces", "err_remove_by_interface", "err_remove_paths", "process_alert_by_interface",
    "process_alert_time", "callout_interfaces", "callout_hosts", "warnings_hosts", "warnings_fs_paths",
    "misc_error_codes", "misc_top_tokens", "top_offenders",
):
    query(_name)(over(tall, getattr(S, _name)))


@query("run_summary")
def _(spark, sf_dir):
    groups = F.map_entries("group_counts")
    text = F.array_join(
        F.transform(groups, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";"
    )
    return S.run_summary(tall(spark, sf_dir)).withColumn("group_counts", text)


query("summary_json")(over(tall, S.summary_json))


# --- the text operators over whole real texts ----------------------------------

TEXT_QUERIES = {
    "interfaces": lambda: [join_or_null(_ids()).alias("interfaces")],
    "error_codes": lambda: [join_or_null(X.error_codes(sd())).alias("error_codes")],
    "error_family_v2": lambda: [families.fixed_family(sd(), "v2").alias("error_family")],
    "error_family_v3": lambda: [families.fixed_family(prefer_text(desc(), sd()), "v3").alias("error_family")],
    "error_family_lexicon": lambda: [
        families.family_v1(text_or_empty(desc())).alias("error_family"),
        families.family_v1(text_or_empty(sd())).alias("error_family_short"),
    ],
    "paths_rooted": lambda: [
        join_or_null(X.paths_rooted(sd(), "v1"), " ").alias("paths_v1"),
        join_or_null(X.paths_rooted(sd(), "v2"), " ").alias("paths_v2"),
        (F.size(X.paths_rooted(sd(), "v2")) > 0).alias("has_path"),
    ],
    "paths_general": lambda: [
        join_list(X.text_paths(_pool())).alias("paths_v5"),
        join_list(X.feature_paths(_pool())).alias("paths_v3"),
    ],
    "normalize_path": lambda: [X.normalize_path(sd()).alias("path")],
    "ftp_code_message": lambda: [
        X.ftp_code(sd()).alias("ftp_code"),
        X.ftp_message(sd()).alias("ftp_message"),
        X.ftp_code(desc()).alias("desc_code"),
        X.ftp_message(desc()).alias("desc_message"),
    ],
    "hosts": lambda: [
        join_list(X.app_hosts(_v4_text(), HOST_DOMAIN)).alias("hosts_v3"),
        join_list(X.app_hosts(_v4_text())).alias("hosts_v4"),
    ],
    "script_name": lambda: [X.script_name(sd()).alias("script_name")],
}
for _name, _columns in TEXT_QUERIES.items():
    query(f"text_{_name}")(per_text(_columns))
