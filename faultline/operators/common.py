"""Shared building blocks of the rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import strip_ws


def constant_table(df: DataFrame, name: str, values: Sequence[str]) -> DataFrame:
    """``position, <name>`` rows of a fixed list, known to the optimizer as a local relation."""
    rows = ", ".join(f"({i}, '{v}')" for i, v in enumerate(values))
    return df.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(position, {name})")


def unknown(name: str) -> Column:
    """Column with NULL shown as ``UNKNOWN``."""
    return F.coalesce(F.col(name), F.lit(P.UNKNOWN)).alias(name)


def value_counts(
    df: DataFrame,
    keys: str | Sequence[str],
    n: int | None = None,
    null_label: str | None = None,
    count: str = "count",
) -> DataFrame:
    """Rows per key, most first, ties by key; the first ``n`` when given.

    NULL keys are left out, or counted as ``null_label``. The NULL test comes
    after the counting (``having``), so Spark does not push it below and
    evaluate a derived key twice.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    if null_label is None:
        all_set = F.lit(True)
        for k in names:
            all_set = all_set & F.col(k).isNotNull()
        rows = F.sum(all_set.cast("bigint"))
        out = df.groupBy(*names).agg(rows.alias(count)).where(F.col(count) > 0)
    else:
        labelled = [F.coalesce(F.col(k), F.lit(null_label)).alias(k) for k in names]
        out = df.select(*labelled).groupBy(*names).agg(F.count(F.lit(1)).alias(count))
    out = out.orderBy(F.col(count).desc(), *names)
    return out if n is None else out.limit(n)


def with_lists_exploded(df: DataFrame, col: str, alias: str) -> DataFrame:
    """One row per element of an array column, which is dropped.

    Outer explode: the inner form would make Spark add a ``size > 0`` filter and
    push it below, evaluating a derived array twice. Rows without elements are
    removed afterwards.
    """
    exploded = df.select("*", F.explode_outer(col).alias(alias)) if alias != col else None
    if exploded is None:
        raise ValueError("alias must differ from the array column")
    return exploded.drop(col).where(F.col(alias).isNotNull())


def explode_list(df: DataFrame, col: str = "paths", alias: str = "path", sep: str = ",") -> DataFrame:
    """One row per non-blank, trimmed item of a separated text column; repeats are kept."""
    parts = F.filter(F.transform(F.split(F.col(col), sep), strip_ws), lambda x: x != "")
    return with_lists_exploded(df.withColumn("_items", parts), "_items", alias)
