"""Column names and presence: resolve, require, null-fill."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip_ws

# Source heading -> our column name.
INCIDENT_COLUMNS = {
    "Number": "number",
    "Opened": "opened",
    "Caller": "caller",
    "Short description": "short_description",
    "Description": "description",
    "Comments": "comments",
    "Category": "category",
    "Severity": "severity",
    "Status": "status",
    "Assignment group": "assignment_group",
    "Assigned to": "assigned_to",
    "Resolution notes": "resolution_notes",
    "Configuration item": "configuration_item",
}
REQUIRED = (
    "number", "caller", "short_description", "description", "category", "severity", "status",
    "assignment_group", "assigned_to", "opened", "resolution_notes",
)
OPTIONAL = ("configuration_item", "comments")
TRIMMED = (
    "short_description", "resolution_notes", "assignment_group", "caller", "status", "category",
    "configuration_item", "assigned_to",
)

# Every column as text: dates arrive as ISO text or day serials and are parsed later.
INCIDENT_SCHEMA = T.StructType([T.StructField(h, T.StringType()) for h in INCIDENT_COLUMNS])


def name_key(name: str) -> str:
    """Comparison form of a column name: no case, no whitespace."""
    return re.sub(r"\s+", "", str(name)).casefold()


def find_column(df: DataFrame, *candidates: str) -> str | None:
    """First column of ``df`` equal to a candidate up to case and whitespace."""
    wanted = {name_key(c) for c in candidates}
    return next((c for c in df.columns if name_key(c) in wanted), None)


def resolve_columns(df: DataFrame) -> DataFrame:
    """Rename known headings to our names; other columns keep their stripped name.

    When several columns resolve to one name the first wins and the rest are dropped.
    """
    ours = {name_key(h): n for h, n in INCIDENT_COLUMNS.items()}
    ours.update({name_key(n): n for n in INCIDENT_COLUMNS.values()})
    picked: dict[str, str] = {}
    for c in df.columns:
        picked.setdefault(ours.get(name_key(c), c.strip()), c)
    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in picked.items()])


def null_fill(df: DataFrame, columns: Iterable[str], dtype: str = "string") -> DataFrame:
    """Append the absent ones among ``columns`` as typed nulls."""
    missing = {c: F.lit(None).cast(dtype) for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


def normalize_schema(
    df: DataFrame, required: Iterable[str] = REQUIRED, optional: Iterable[str] = OPTIONAL
) -> DataFrame:
    """Our column names; ``ValueError`` for a missing required one, nulls for an optional one."""
    out = resolve_columns(df)
    missing = [c for c in required if c not in out.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return null_fill(out, optional)


def trim_strings(df: DataFrame, columns: Iterable[str] = TRIMMED) -> DataFrame:
    """Strip surrounding whitespace of the text columns present."""
    return df.withColumns({c: strip_ws(F.col(c)) for c in columns if c in df.columns})
