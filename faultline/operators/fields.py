"""Row-level field extraction over an incident table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions import families, times
from ..functions.text import join_list, join_or_null, pool_text, prefer_text, text_or_empty

KEPT_COLUMNS = ("number", "short_description", "caller", "status", "severity", "assignment_group", "opened")
HELPER_TYPES = {
    "error_family": "string",
    "stuck_files_count": "bigint",
    "stuck_for_minutes": "bigint",
    "paths": "string",
    "has_path": "boolean",
    "ftp_command": "string",
    "ftp_code": "string",
    "interfaces": "string",
    "primary_interface": "string",
    "permission_denied": "boolean",
    "not_connected": "boolean",
}


def _with_matches(df: DataFrame, text: Column, profile: str) -> tuple[DataFrame, list[str]]:
    """Add the shared matches in a stage of their own, so each pattern is searched once."""
    found = {
        "_ids": X.interface_ids(text),
        "_codes": X.error_codes(text),
        "_paths": X.paths_rooted(text, profile),
    }
    if profile == "v1":
        found["error_family"] = families.family_v1(text_or_empty(text))
    else:
        found["_token"] = families.family_token(text, "v2")
        found.update(times.raw_times(text, "v2"))
    out = df.withColumns(found)
    if profile == "v2":
        out = out.withColumn("error_family", families.normalize_family(F.col("_token"), "v2"))
    return out, [c for c in found if c.startswith("_")]


def _shared_fields(text: Column, profile: str) -> dict[str, Column]:
    return {
        "interfaces": join_or_null(F.col("_ids")),
        "primary_interface": X.primary_interface(F.col("_ids")),
        "error_codes": join_or_null(F.col("_codes")),
        "paths": join_or_null(F.col("_paths")),
        "has_path": F.size("_paths") > 0,
        "stuck_files_count": X.stuck_count(text, profile),
        "stuck_for_minutes": X.stuck_minutes(text, profile),
    }


def extract_fields(
    df: DataFrame,
    text_col: str,
    profile: str = "v2",
    raw_chain: bool = False,
    host_prefix: str | None = None,
) -> DataFrame:
    """Append the fields found in ``text_col``; same-named columns are replaced.

    ``v1`` is the lexicon profile used for enrichment, ``v2`` the fixed-pattern
    profile of the short description. List fields are comma-joined text, NULL
    when empty.
    """
    if profile not in ("v1", "v2"):
        raise ValueError(f"unknown profile {profile!r}")
    text = F.col(text_col)
    fields = _shared_fields(text, profile)
    matched, temporary = _with_matches(df, text, profile)
    if profile == "v1":
        fields["error_anomalies_unmatched"] = join_or_null(
            families.unmatched_anomalies(text_or_empty(text), F.col("error_family")), "; "
        )
    else:
        fields.update(
            {
                "interface_count": F.size("_ids").cast("bigint"),
                "interface_chain": X.chain_clean(text, F.col("_ids")),
                "ftp_command": X.ftp_command(text),
                "ftp_code": X.ftp_code_550(text),
                "permission_denied": X.permission_denied(text),
                "not_connected": X.not_connected(text),
                **times.fired_time(F.col("_iso"), F.col("_named")),
                "script_name": X.script_name(text),
                "host_tag": X.host_tag(text, host_prefix),
                "warning_subject": X.warning_subject(text, F.col("error_family")),
            }
        )
        if raw_chain:
            fields["interface_chain_raw"] = X.chain_raw(text)
    return matched.withColumns(fields).drop(*temporary)


def shortdesc_extract(df: DataFrame, raw_chain: bool = False, host_prefix: str | None = None) -> DataFrame:
    """Kept source columns present in ``df``, the v2 fields, and the caller class."""
    caller = X.caller_class(F.col("caller")) if "caller" in df.columns else F.lit("Other")
    kept = [c for c in KEPT_COLUMNS if c in df.columns]
    out = extract_fields(df, "short_description", "v2", raw_chain, host_prefix).withColumn("caller_class", caller)
    added = [
        "interfaces", "primary_interface", "interface_count", "interface_chain", "error_family",
        "error_codes", "ftp_command", "ftp_code", "paths", "has_path", "stuck_files_count",
        "stuck_for_minutes", "fired_time", "fired_time_source", "script_name", "host_tag",
        "warning_subject", "caller_class",
    ]
    if raw_chain:
        added.insert(4, "interface_chain_raw")
    return out.select(*kept, *added)


def _given(c: Column, dtype: str) -> Column:
    """An existing helper value as its type; whole numbers also when written ``3.0``, other text is NULL."""
    text = c.cast("string")
    return text.try_cast("double").try_cast(dtype) if dtype == "bigint" else text.try_cast(dtype)


def ensure_helpers(df: DataFrame, derive: bool = True, text_col: str | None = "short_description") -> DataFrame:
    """Make the helper columns present.

    ``derive`` keeps an existing value and fills a missing one from the text.
    Otherwise absent columns become nulls, or ``false`` for flags.
    """
    if not derive:
        return df.withColumns(
            {
                name: (F.lit(False) if dtype == "boolean" else F.lit(None).cast(dtype))
                for name, dtype in HELPER_TYPES.items()
                if name not in df.columns
            }
        )
    if text_col is None or text_col not in df.columns:
        raise ValueError("a text column is required to derive helper columns")
    derived = [*HELPER_TYPES, "error_codes"]
    existing = {c: f"_given_{c}" for c in df.columns if c in derived}
    out = extract_fields(df.withColumnsRenamed(existing), text_col, "v2")
    out = out.withColumns(
        {
            c: F.coalesce(_given(F.col(given), HELPER_TYPES.get(c, "string")), F.col(c))
            for c, given in existing.items()
        }
    )
    return out.select(*df.columns, *[c for c in derived if c not in df.columns])


FEATURE_COLUMNS = (
    "error_family_extracted", "src_interface", "route_or_mid", "dst_interface", "extracted_timestamp",
    "operation", "operation_success", "operation_tags", "ftp_code", "ftp_message", "hosts", "paths",
    "file_patterns", "stuck_minutes", "stuck_count", "fms_err_class",
)


def feature_text(profile: str) -> Column:
    """Text a feature profile reads: v3 the description (else short description), v4 four columns."""
    if profile == "v3":
        return prefer_text(F.col("description"), F.col("short_description"))
    if profile == "v4":
        return pool_text(*[F.col(c) for c in ("short_description", "resolution_notes", "description", "comments")])
    raise ValueError(f"unknown profile {profile!r}")


def extract_features(
    df: DataFrame,
    profile: str = "v3",
    allow_non_abs: bool = False,
    append_only: bool = False,
    domain: str | None = None,
) -> DataFrame:
    """Append the feature columns of profile ``v3`` or ``v4``; ``append_only`` returns just them.

    Absent text is ``''`` as in the source tables; the two stuck metrics are
    numbers, NULL when absent. Only v3 reads the error class and domain hosts.
    """
    given = [c for c in df.columns if c not in FEATURE_COLUMNS]
    text = F.col("_text")
    step = df.withColumn("_text", text_or_empty(feature_text(profile)))
    step = step.withColumns(
        {
            "_tags": X.operation_tags(text, profile),
            "_token": families.family_token(text, profile),
            **times.raw_times(text, profile),
        }
    )
    fired = F.col("_fired") if profile == "v3" else None
    fields = {
        "error_family_extracted": families.normalize_family(F.col("_token"), profile),
        **X.triplet(text),
        "extracted_timestamp": times.extracted_timestamp(F.col("_iso"), F.col("_named"), fired),
        "operation": X.operation(text, F.col("_tags")),
        "operation_success": X.operation_success(F.col("_tags"), profile),
        "operation_tags": join_list(F.col("_tags")),
        "ftp_code": X.ftp_code(text),
        "ftp_message": X.ftp_message(text),
        "hosts": join_list(X.app_hosts(text, domain if profile == "v3" else None)),
        "paths": join_list(X.feature_paths(text, allow_non_abs)),
        "file_patterns": join_list(X.file_patterns(text, profile)),
        "stuck_minutes": X.stuck_minutes(text, profile),
        "stuck_count": X.stuck_count(text, profile),
    }
    if profile == "v3":
        fields["fms_err_class"] = X.fms_class(text)
    out = step.withColumns(fields)
    return out.select(*([] if append_only else given), *fields)
