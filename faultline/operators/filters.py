"""Filters, option lists and drill-through of the exploration views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.extract import basename
from ..functions.text import strip_ws
from ..functions.times import opened_time
from ..session import written
from .common import with_lists_exploded

INCIDENT_TEXT = ("short_description", "paths", "error_codes", "resolution_notes")
PATH_TEXT = ("path", "configuration_items", "error_families", "top_primary_interfaces")
DRILL_TEXT = ("paths", "short_description", "resolution_notes")
PREVIEW_LIMIT = 10_000


def _pooled(df: DataFrame, columns: Sequence[str]) -> Column:
    present = [F.col(c) for c in columns if c in df.columns]
    return F.lower(F.concat_ws(" ", *present))


def _has(c: Column, needle: str) -> Column:
    """Literal, case-insensitive containment; NULL contains nothing."""
    return F.coalesce(F.lower(c).contains(needle.lower()), F.lit(False))


def filter_incidents(
    df: DataFrame,
    interface: str | None = None,
    family: str | None = None,
    ftp_command: str | None = None,
    ftp_code: str | None = None,
    text: str | None = None,
    months: Sequence[str] | None = None,
    dows: Sequence[str] | None = None,
    hours: tuple[int, int] | None = None,
) -> DataFrame:
    """Incidents passing every filter given; an unset filter, or one whose column is absent, is skipped.

    ``text`` is sought literally in four columns joined by spaces. The full
    range 0-23 of ``hours`` is no filter, so incidents without an hour stay.
    """
    tests: list[Column] = []

    def has(name: str, value) -> bool:
        return bool(value) and name in df.columns

    if has("primary_interface", interface):
        tests.append(F.col("primary_interface") == interface)
    if has("error_family", family):
        tests.append(F.col("error_family") == family)
    if has("ftp_command", ftp_command):
        tests.append(F.upper("ftp_command") == ftp_command.upper())
    if has("ftp_code", ftp_code):
        tests.append(F.col("ftp_code") == ftp_code)
    query = (text or "").strip()
    if query and any(c in df.columns for c in INCIDENT_TEXT):
        tests.append(_pooled(df, INCIDENT_TEXT).contains(query.lower()))
    if has("month", months):
        tests.append(F.col("month").isin(*months))
    if has("dow", dows):
        tests.append(F.col("dow").isin(*dows))
    if has("hour", hours) and tuple(hours) != (0, 23):
        tests.append(F.col("hour").between(int(hours[0]), int(hours[1])))
    for test in tests:
        df = df.where(test)
    return df


def _lists(c: Column) -> Column:
    return F.transform(F.split(F.coalesce(c, F.lit("")), ";"), strip_ws)


def filter_paths(
    paths: DataFrame,
    interface: str | None = None,
    family: str | None = None,
    text: str | None = None,
    path_prefix: str | None = None,
    min_incidents: int | None = None,
    ci_choice: str | None = None,
    family_choice: str | None = None,
    file_name: str | None = None,
) -> DataFrame:
    """Path-table rows passing every filter given.

    ``interface``, ``family`` and ``text`` are literal substrings; ``ci_choice``
    and ``family_choice`` must equal one item of the ``;``-joined cell, ignoring
    case; ``file_name`` is sought in the last path component.
    """
    tests: list[Column] = []
    if interface:
        tests.append(_has(F.col("top_primary_interfaces"), interface))
    if family:
        tests.append(_has(F.col("error_families"), family))
    query = (text or "").strip()
    if query:
        tests.append(_pooled(paths, PATH_TEXT).contains(query.lower()))
    if path_prefix:
        tests.append(F.col("path").startswith(path_prefix.strip()))
    if min_incidents is not None:
        tests.append(F.coalesce(F.col("incident_count"), F.lit(0)) >= int(min_incidents))
    for column, choice in (("configuration_items", ci_choice), ("error_families", family_choice)):
        if choice and choice != "(any)":
            tests.append(F.array_contains(_lists(F.lower(F.col(column))), choice.strip().lower()))
    if file_name:
        tests.append(_has(basename(F.col("path")), file_name.strip()))
    for test in tests:
        paths = paths.where(test)
    return paths


def filter_options(
    df: DataFrame,
    columns: Sequence[str] = ("primary_interface", "error_family", "ftp_command", "ftp_code", "month"),
) -> DataFrame:
    """Distinct non-null values of each column as ``option, value``, sorted; one pass."""
    present = [c for c in columns if c in df.columns]
    cells = F.array(*[F.struct(F.lit(c).alias("option"), F.col(c).cast("string").alias("value")) for c in present])
    return (
        df.select(F.inline(cells))
        .groupBy("option", "value")
        .agg(F.count("value").alias("_n"))
        .where(F.col("_n") > 0)
        .select("option", "value")
        .orderBy("option", "value")
    )


def joined_choices(
    paths: DataFrame, columns: Sequence[str] = ("configuration_items", "error_families")
) -> DataFrame:
    """Distinct items of ``;``-joined cells as ``option, value``, sorted."""
    cells = F.array(*[F.struct(F.lit(c).alias("option"), _lists(F.col(c)).alias("items")) for c in columns])
    items = with_lists_exploded(paths.select(F.inline(cells)), "items", "value")
    return items.where(F.col("value") != "").distinct().orderBy("option", "value")


def top_paths(paths: DataFrame, n: int = 30) -> DataFrame:
    return paths.orderBy(F.col("incident_count").desc(), "path").limit(n)


def preview(
    df: DataFrame, opened: str = "opened", then: Sequence[str] = ("number",), n: int = PREVIEW_LIMIT
) -> DataFrame:
    """First ``n`` rows by opening time, then by the columns ``then``.

    A plain top-``n`` would send ``n`` wide rows of every task to one. So rows are
    counted per day of the opening time as read, and of the days that hold the first
    ``n`` only the sort keys are ranked; the full rows are those with one of these keys.
    Rows whose time cannot be read come last.
    """
    first = opened_time(df, opened)
    days = df.groupBy(first.cast("date").alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    so_far = F.sum("rows").over(W.orderBy(F.col("day").asc_nulls_last()).rowsBetween(W.unboundedPreceding, W.currentRow))
    enough = days.withColumn("so_far", so_far).where((F.col("so_far") >= n) & F.col("day").isNotNull())
    last_day = enough.agg(F.min("day")).scalar()
    early = df.where(last_day.isNull() | (first.cast("date") <= last_day)).withColumn("_first", first)
    names = ("_first", *then)
    order = [F.col("_first").asc_nulls_last(), *then]
    keys = early.select(*names).orderBy(*order).limit(n).distinct().select(*[F.col(c).alias(f"_key{k}") for k, c in enumerate(names)])
    same = F.lit(True)
    for k, c in enumerate(names):
        same = same & F.col(c).eqNullSafe(F.col(f"_key{k}"))
    # At most ``n`` narrow keys; the rows that match them are ``n`` and any that equal the last key.
    return early.join(F.broadcast(keys), same, "left_semi").orderBy(*order).limit(n).drop("_first")


def drill_through(df: DataFrame, path: str) -> DataFrame:
    """Incidents whose paths, short description or notes contain ``path``, ignoring case."""
    if not path:
        return df.where(F.lit(False))
    hit = F.lit(False)
    for c in DRILL_TEXT:
        if c in df.columns:
            hit = hit | _has(F.col(c), path)
    return df.where(hit)


# A path of GRAM characters or more is known by one of its grams of that length, a shorter one by itself.
GRAM = 6
BLOCK_CHARS = 1 << 16  # characters of a text whose grams are made at once


def drill_through_all(df: DataFrame, paths: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``path, matching_incidents`` for every path of a path table.

    Same test as :func:`drill_through`, right for any path. Each path has one anchor:
    of its grams the one that the fewest paths share. A text holding the path holds its
    anchor, so an equi-join on the anchor's hash gives every candidate pair, which is
    then tested on the whole text. Only row numbers and hashes meet in that join (16
    bytes a character where Spark does not broadcast the anchors), the texts are joined
    by row afterwards; both tables may be of any size.
    """
    keyed = written(paths.select("path", F.lower("path").alias("key")), "drill-paths")
    keys = keyed.where("key <> ''").select("key").distinct()
    names = [c for c in DRILL_TEXT if c in df.columns]
    if names:
        cells = df.select(F.monotonically_increasing_id().alias("id"), *[F.lower(F.col(c)).alias(c) for c in names])
        rows = written(cells.where(F.coalesce(*names).isNotNull()), "drill")
        short = keys.where(F.length("key") < GRAM).select(F.length("key").alias("n")).distinct()
        lengths = sorted(r.n for r in short.collect())  # fewer than GRAM numbers
        texts = rows.select("id", F.explode(F.array(*names)).alias("text"))
        anchors = written(_anchors(keys, block_chars), "drill-anchors")  # its size is known before the join is planned
        candidates = _grams(texts, "id", block_chars, lengths).join(anchors, "gram").select("id", "key").distinct()
        hit = F.lit(False)
        for c in names:
            hit = hit | F.coalesce(F.col(c).contains(F.col("key")), F.lit(False))
        counted = candidates.join(rows, "id").where(hit).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        keyed = keyed.join(counted, "key", "left")
    else:
        keyed = keyed.withColumn("n", F.lit(None).cast("long"))
    return keyed.select("path", F.coalesce("n", F.lit(0)).alias("matching_incidents")).orderBy(
        F.col("matching_incidents").desc(), "path"
    )


def _anchors(keys: DataFrame, block_chars: int) -> DataFrame:
    """``key`` and the hash of its anchor, ``gram``."""
    short = keys.where(F.length("key") < GRAM).select("key", F.xxhash64(F.length("key"), "key").alias("gram"))
    grams = _grams(keys.where(F.length("key") >= GRAM).select("key", F.col("key").alias("text")), "key", block_chars, []).distinct()
    shared = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = grams.join(shared, "gram").groupBy("key").agg(F.min(F.struct("n", "gram")).alias("least"))
    return short.unionByName(rarest.select("key", "least.gram"))


def _grams(texts: DataFrame, name: str, block_chars: int, lengths: Sequence[int]) -> DataFrame:
    """``name`` and ``gram``: hashes of the grams of ``text`` of GRAM characters and of the shorter ``lengths``.

    A text is cut into blocks that reach far enough into the next to lose no gram, so memory is bounded.
    """
    cut = f"(?s)(?=(.{{1,{block_chars + GRAM - 1}}})).{{1,{block_chars}}}"
    blocks = texts.select(name, F.explode(F.regexp_extract_all("text", F.lit(cut), F.lit(1))).alias("block"))
    ahead = F.regexp_extract_all("block", F.lit(f"(?s)(?=(.{{1,{GRAM}}}))"), F.lit(1))
    found = blocks.select(name, F.explode(ahead).alias("ahead"))
    hashes = [F.when(F.length("ahead") >= n, F.xxhash64(F.lit(n), F.left("ahead", F.lit(n)))) for n in (GRAM, *lengths)]
    grams = found.select(name, F.explode(F.array(*hashes)).alias("gram") if lengths else hashes[0].alias("gram"))
    return grams.where(F.col("gram").isNotNull())
