"""Unique-path rollup: which paths appear in which incidents, with their context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions import families
from ..functions import patterns as P
from ..functions.times import opened_time
from ..functions.text import is_blank, pool_text, text_or_empty
from ..sources.schema import null_fill
from .common import with_lists_exploded

_TEXT_COLUMNS = ("short_description", "description", "resolution_notes", "comments")
_INPUTS = ("number", "paths", *_TEXT_COLUMNS, "configuration_item", "error_family", "primary_interface")


def rederive_family(
    df: DataFrame, lexicon: Sequence[str], description_only: bool = True, force: bool = False
) -> DataFrame:
    """Fill ``error_family`` from the text by the lexicon where it is NULL or blank; everywhere if ``force``.

    A text without any lexicon name gives ``''``. An empty lexicon changes nothing.
    """
    df = null_fill(df, ("error_family",))
    if not lexicon:
        return df
    text = text_or_empty(F.col("description")) if description_only else pool_text(*[F.col(c) for c in _TEXT_COLUMNS])
    derived = families.flex_family(text, lexicon, "")
    kept = F.col("error_family")
    value = derived if force else F.when(is_blank(kept), derived).otherwise(kept)
    return df.withColumn("error_family", value)


def incident_paths(
    df: DataFrame, description_only: bool = True, allow_non_abs: bool = False, unc: bool = True
) -> DataFrame:
    """Append ``path_list``: the incident's distinct paths.

    An explicit ``paths`` cell wins; otherwise paths are read from the text and,
    unless ``allow_non_abs``, kept only when absolute. ``unc=False`` leaves out
    network shares and applies the absolute test to explicit cells too.
    """
    df = null_fill(df, _INPUTS)
    cell = F.col("paths")
    source = F.col("description") if description_only else pool_text(*[F.col(c) for c in _TEXT_COLUMNS])
    found = X.text_paths(source, allow_non_abs, unc)
    listed = X.split_paths(cell)
    if not allow_non_abs:
        found = X.absolute_only(found, unc)
        listed = listed if unc else X.absolute_only(listed, unc=False)
    parts = F.when(~is_blank(cell), listed).otherwise(found)
    return df.withColumn("path_list", F.array_distinct(F.filter(parts, lambda p: p != "")))


def path_scan_stats(with_paths: DataFrame) -> DataFrame:
    """One row: incidents scanned, incidents with a path, (incident, path) rows."""
    n = F.size("path_list")
    return with_paths.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.coalesce(F.sum((n > 0).cast("bigint")), F.lit(0)).alias("incidents_with_path"),
        F.coalesce(F.sum(n.cast("bigint")), F.lit(0)).alias("exploded_rows"),
    )


def path_dedup(with_paths: DataFrame, order: str = "opened") -> DataFrame:
    """First row per (incident, path), by opening time as read, unread ones last.

    An aggregate with map-side combine, not a window: any number of copies of a
    pair shrink to one row before the shuffle. Copies at one time are told apart
    by their values.
    """
    context = ("configuration_item", "error_family", "primary_interface")
    order_by = opened_time(with_paths, order) if order in with_paths.columns else F.lit(None).cast("timestamp_ntz")
    pairs = with_lists_exploded(
        with_paths.select("number", order_by.alias("_order"), *context, "path_list"), "path_list", "path"
    )
    return (
        pairs.groupBy("number", "path")
        .agg(F.min(F.struct(F.col("_order").isNull().alias("_unread"), "_order", *context)).alias("_first"))
        .select("number", "path", *[F.col(f"_first.{c}").alias(c) for c in context])
    )


def path_facts(pairs: DataFrame) -> DataFrame:
    """``path, kind, value, n``: incidents of each path (kind ``incidents``) and of its CIs, families and interfaces.

    One hash aggregate over (path, kind, value), so the pairs of a hot path are spread
    and shrink to its distinct names before anything is gathered per path.
    """

    def fact(kind: str, column: str, there: Column) -> Column:
        return F.when(there, F.struct(F.lit(kind).alias("kind"), F.col(column).alias("value")))

    facts = F.array(
        F.struct(F.lit("incidents").alias("kind"), F.lit(None).cast("string").alias("value")),
        fact("ci", "configuration_item", ~is_blank(F.col("configuration_item"))),
        fact("family", "error_family", ~is_blank(F.col("error_family"))),
        fact("interface", "primary_interface", F.col("primary_interface").isNotNull()),
    )
    rows = pairs.select("path", "number", F.inline(F.array_compact(facts)))
    counted = F.when(F.col("kind") == "incidents", F.col("number").isNotNull()).otherwise(True)
    return rows.groupBy("path", "kind", "value").agg(F.sum(counted.cast("bigint")).alias("n"))


def _names(kind: str) -> Column:
    """The distinct values of a kind in order, joined by ``; ``."""
    value = F.when(F.col("kind") == kind, F.col("value"))
    return F.array_join(F.array_sort(F.collect_list(value)), "; ")


def top_interfaces(pairs: DataFrame, top: int = 5) -> DataFrame:
    """Most frequent interfaces of each path as ``name (n)``, joined by ``; ``.

    The rank limit is applied before the counts are shuffled by path.
    """
    return _top_of(path_facts(pairs), top)


def _top_of(facts: DataFrame, top: int) -> DataFrame:
    ranking = W.partitionBy("path").orderBy(F.col("n").desc(), "value")
    ranked = (
        facts.where(F.col("kind") == "interface")
        .withColumn("rank", F.row_number().over(ranking))
        .where(F.col("rank") <= top)
    )
    text = F.concat("value", F.lit(" ("), F.col("n").cast("string"), F.lit(")"))
    items = F.array_sort(F.collect_list(F.struct("rank", text.alias("text"))))
    return ranked.groupBy("path").agg(F.array_join(items["text"], "; ").alias("top_primary_interfaces"))


def rollup_paths(pairs: DataFrame, top: int = 5, min_count: int = 1) -> DataFrame:
    """Per path: incidents, CIs, families and top interfaces; most incidents first.

    Both inputs of the join come from the same facts, whose shuffle they share.
    """
    facts = path_facts(pairs)
    named = facts.where(F.col("kind") != "interface")
    counts = named.groupBy("path").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "incidents", F.col("n"))), F.lit(0)).alias("incident_count"),
        _names("ci").alias("configuration_items"),
        _names("family").alias("error_families"),
    )
    out = counts.join(_top_of(facts, top), "path", "left").withColumn(
        "top_primary_interfaces", text_or_empty(F.col("top_primary_interfaces"))
    )
    if min_count > 1:
        out = out.where(F.col("incident_count") >= min_count)
    return out.orderBy(F.col("incident_count").desc(), "path")


def unique_paths(
    df: DataFrame,
    lexicon: Sequence[str] = P.FAMILY_LEXICON,
    description_only: bool = True,
    derive: bool = True,
    force: bool = False,
    allow_non_abs: bool = False,
    min_count: int = 1,
    unc: bool = True,
) -> DataFrame:
    """``path, incident_count, configuration_items, error_families, top_primary_interfaces``."""
    rows = null_fill(df, _INPUTS)
    if derive:
        rows = rederive_family(rows, lexicon, description_only, force)
    pairs = path_dedup(incident_paths(rows, description_only, allow_non_abs, unc))
    return rollup_paths(pairs, min_count=min_count)


def unique_paths_fixed(df: DataFrame, derive: bool = False, allow_non_abs: bool = False) -> DataFrame:
    """Older form: fixed-pattern families, all text columns, no network shares."""
    rows = null_fill(df, _INPUTS)
    text = pool_text(*[F.col(c) for c in ("short_description", "resolution_notes", "description", "comments")])
    if derive:
        kept = F.col("error_family")
        found = families.fixed_family_or_empty(text)
        rows = rows.withColumn("error_family", F.when(is_blank(kept), found).otherwise(kept))
    pairs = path_dedup(incident_paths(rows, False, allow_non_abs, unc=False))
    return rollup_paths(pairs)
