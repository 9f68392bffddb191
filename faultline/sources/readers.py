"""Readers: incident files, sheets, CI lookup, lexicon, runs, path tables."""

from __future__ import annotations

import collections
import csv
import functools
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..functions.text import strip_ws
from ..session import written
from .schema import find_column, resolve_columns

CI_HEADINGS = ("CI", "CI_role", "CI_protocol", "CI_env", "CI_techstack", "CI_criticality")
CI_SCHEMA = T.StructType([T.StructField(h.lower(), T.StringType()) for h in CI_HEADINGS])
UNIQUE_PATHS_SCHEMA = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in ("path", "incident_count", "configuration_items", "error_families", "top_primary_interfaces")
    ]
)
#: Before the folder name of a run that is being replaced; Spark does not see such folders.
SET_ASIDE = "_old-"
# CSV dialect shared by the reader and the sink: quotes doubled, line ends allowed
# inside quotes. An empty cell, quoted or not, reads as NULL.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """CSV with a declared schema, so nothing is scanned to infer types.

    ``multi_line`` allows line ends inside quotes but makes each file one task:
    give large exports as many files, or turn it off where no cell has line ends.
    """
    options = {**CSV_OPTIONS, "multiLine": str(multi_line).lower()}
    return spark.read.schema(schema).options(**options).csv(path)


def read_csv_by_heading(
    spark: SparkSession, path: str, multi_line: bool = True, headings: str = "each"
) -> DataFrame:
    """CSV whose columns go by the headings written in the files, all as text; nothing is scanned to infer types.

    ``headings="each"`` goes by the catalogue of :func:`csv_parts` and puts files with
    different columns or order together by our names, absent ones as NULL. ``"first"``
    takes the first file's for all, and Spark fails where another file's differ.
    """
    if headings == "first":
        options = {**CSV_OPTIONS, "multiLine": str(multi_line).lower(), "enforceSchema": "false"}
        files = sorted(spark.read.text(path).inputFiles())
        names = spark.read.options(**options).csv(files[0]).columns
        return resolve_columns(spark.read.schema(_text_schema(names)).options(**options).csv(path))
    if headings != "each":
        raise ValueError(f"headings must be 'each' or 'first', not {headings!r}")
    parts = [resolve_columns(part) for part in csv_parts(spark, path, multi_line)]
    if not parts:
        raise ValueError(f"no headings in {path}")
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def heading_names(line: str) -> list[str] | None:
    """Column names in a heading line, as Spark's CSV reader would name them; None if a quoted name is not closed."""
    if line.count('"') % 2:
        return None
    names = next(csv.reader([line.removeprefix("\ufeff")]))
    times = collections.Counter(n.lower() for n in names)
    return [f"{n}{k}" if n and times[n.lower()] > 1 else n or f"_c{k}" for k, n in enumerate(names)]


def csv_headings(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """Catalogue of ``(heading line, files)``, from one distributed pass whatever the number of files.

    A file's heading is its first line that is not blank, found among the rows of its
    first block. What reaches the driver are the file names, which it lists anyway.
    """
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    early = lines.where((F.col("file_block_start") == 0) & (strip_ws(F.col("value")) != ""))
    placed = early.withColumn("place", F.monotonically_increasing_id())
    firsts = placed.groupBy("file_path").agg(F.min_by("value", "place").alias("heading"))
    groups = firsts.groupBy("heading").agg(F.array_sort(F.collect_list("file_path")).alias("files")).collect()
    return sorted(((r["heading"], r["files"]) for r in groups), key=lambda g: g[1][0])


def csv_parts(spark: SparkSession, path: str, multi_line: bool = True) -> list[DataFrame]:
    """The files of each distinct heading as one table with their own column names, all text, in order of their first file."""
    options = {**CSV_OPTIONS, "multiLine": str(multi_line).lower()}
    parts = []
    for heading, files in csv_headings(spark, path):
        members = [unquote(f) for f in files]
        names = heading_names(heading) or spark.read.options(**options).csv(members[0]).columns
        parts.append(spark.read.schema(_text_schema(names)).options(**options).csv(members))
    return parts


def _text_schema(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_incidents(
    spark: SparkSession,
    path: str,
    sheet: str | int | None = None,
    fmt: str = "parquet",
    multi_line: bool = True,
    headings: str = "each",
) -> DataFrame:
    """Incident table from ``parquet`` or ``csv``, a file or a folder of parts, optionally one sheet of it."""
    if fmt == "csv":
        df = read_csv_by_heading(spark, path, multi_line, headings)
    elif fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return df if sheet is None else select_sheet(df, sheet)


def _sheet_names(df: DataFrame) -> list[str]:
    """Sheet names in order; a workbook-sized list, read as metadata when it is a partition column."""
    return [r[0] for r in df.select("source_sheet").distinct().orderBy("source_sheet").collect()]


def select_sheet(
    df: DataFrame, sheet: str | int | None = None, strict: bool = True, sheets: Sequence[str] | None = None
) -> DataFrame:
    """Rows of one sheet.

    ``strict``: first by default (also ``''``, ``first``, ``0``), by index, or by
    name, ``ValueError`` for an unknown one. Otherwise: the named sheet if it
    exists, else ``data``, else the first. ``sheets`` gives the workbook's order and
    saves looking for the names; a table keeps none, so without it they count in
    alphabetical order.
    """
    names = list(sheets) if sheets is not None else _sheet_names(df)
    if not names:
        return df
    if not strict:
        choice = sheet if sheet in names else ("data" if "data" in names else names[0])
    elif sheet is None or str(sheet).strip().lower() in ("", "first", "0"):
        choice = names[0]
    elif isinstance(sheet, int) or str(sheet).strip().lstrip("-").isdigit():
        index = int(sheet)
        if not 0 <= index < len(names):
            raise ValueError(f"sheet index {index} out of range; available: {names}")
        choice = names[index]
    else:
        choice = sheet.strip()
        if choice not in names:
            raise ValueError(f"sheet {choice!r} not found; available: {names}")
    return df.where(F.col("source_sheet") == choice)


def union_sheets(sheets: Mapping[str, DataFrame], tag: bool = True) -> DataFrame:
    """All sheets in one table, tagged with ``source_sheet`` when ``tag``; absent columns are null."""
    out: DataFrame | None = None
    for name, df in sheets.items():
        part = df.withColumn("source_sheet", F.lit(name)) if tag else df
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no sheets")
    return out


def normalize_ci_lookup(df: DataFrame, *kept: str) -> DataFrame:
    """Check the lookup's columns and give them our names; columns ``kept`` stay."""
    found = {h: find_column(df, h) for h in CI_HEADINGS}
    missing = [h for h, c in found.items() if c is None]
    if missing:
        raise ValueError(f"ci lookup is missing columns: {', '.join(missing)}")
    return df.select(*[F.col(c).cast("string").alias(h.lower()) for h, c in found.items()], *kept)


def read_ci_lookup(spark: SparkSession, path: str | None) -> DataFrame:
    """CI lookup from CSV by the heading of each file; no path or an unreadable file gives an empty lookup.

    Line order, over several files by their names, is kept in ``line_no``, because
    of duplicate keys the last line wins. A file without one of the columns is an error.
    """
    empty = spark.createDataFrame([], CI_SCHEMA).withColumn("line_no", F.lit(None).cast("string"))
    if not path:
        return empty
    try:
        parts = csv_parts(spark, path)
    except AnalysisException:
        return empty
    named = [normalize_ci_lookup(part.withColumn("line_no", line_order()), "line_no") for part in parts]
    return functools.reduce(DataFrame.unionByName, named) if named else empty


def line_order() -> Column:
    """Order of a line among files: by path, place in the file, then row."""
    place = F.lpad(F.col("_metadata.file_block_start").cast("string"), 19, "0")
    row = F.lpad(F.monotonically_increasing_id().cast("string"), 19, "0")
    return F.concat_ws(":", "_metadata.file_path", place, row)


def read_lexicon(spark: SparkSession, path: str | None) -> DataFrame:
    """Lexicon file as ``line_no, family``: stripped, blanks dropped, first of duplicates kept.

    ``line_no`` orders the lines, of several files by their names. No path or an
    absent file gives an empty lexicon.
    """
    empty = spark.createDataFrame([], "line_no string, family string")
    if not path:
        return empty
    try:
        raw = spark.read.text(path)
    except AnalysisException:
        return empty
    lines = raw.select(
        line_order().alias("line_no"), strip_ws(F.col("value")).alias("family")
    )
    first = lines.where(F.col("family") != "").groupBy("family").agg(F.min("line_no").alias("line_no"))
    return first.select("line_no", "family")


def numbered(df: DataFrame, order: str) -> DataFrame:
    """``df`` with ``position``, counted from 0 in ascending ``order``.

    Rows are dealt by ranges and sorted there; the number of rows before each
    range comes from one count per range, so no task sees all rows.
    """
    sorted_rows = df.repartitionByRange(order).sortWithinPartitions(order)
    rows = written(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn("_range", F.shiftright("_at", 33))
    counts = rows.groupBy("_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    starts = counts.select("_range", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    placed = rows.join(starts, "_range").withColumn("position", F.col("_at") + F.col("_shift"))
    return placed.select(*df.columns, "position")


def lexicon_positions(lexicon: DataFrame) -> DataFrame:
    """``position, family``: the lexicon's entries with their place from 0."""
    return numbered(lexicon, "line_no").select("position", "family")


def lexicon_names(lexicon: DataFrame) -> list[str]:
    """Lexicon as an ordered list for building a pattern."""
    return [r[0] for r in lexicon.orderBy("line_no").select("family").collect()]


def read_group(spark: SparkSession, path: str, run_id: str, scenario: str) -> DataFrame:
    """Rows of one scenario of a run; partition pruning reads only its files.

    A scenario without rows gives an empty table.
    """
    return group_rows(read_run(spark, path, run_id), run_id, scenario)


def group_rows(runs: DataFrame, run_id: str, scenario: str) -> DataFrame:
    name = scenario.replace("callout/", "callout_")
    return runs.where((F.col("run_id") == run_id) & (F.col("scenario") == name))


def latest_run(runs: DataFrame) -> DataFrame:
    """Rows of the run whose name sorts last."""
    newest = runs.agg(F.max("run_id"))
    return runs.where(F.col("run_id") == newest.scalar())


def run_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the stored runs, newest first, from the folder listing; no file is opened.

    A run that was set aside and whose replacement never came counts.
    """
    found = {n.removeprefix(SET_ASIDE) for n in _folders(spark, path)}
    return sorted((n.removeprefix("run_id=") for n in found if n.startswith("run_id=")), reverse=True)


def _folders(spark: SparkSession, path: str) -> list[str]:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return [s.getPath().getName() for s in folder.getFileSystem(conf).listStatus(folder) if s.isDirectory()]


def read_run(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """A stored run, by default the one whose name sorts last; other runs' files are not read.

    While a run is being replaced, or if that failed half-way, the old one is read where it was set aside.
    """
    name = run_names(spark, path)[0] if run_id is None else run_id
    folders = set(_folders(spark, path))
    if f"run_id={name}" not in folders and (aside := f"{SET_ASIDE}run_id={name}") in folders:
        old = spark.read.parquet(f"{path}/{aside}")
        kept = [c for c in old.columns if c != "scenario"]
        return old.select(*kept, F.lit(name).alias("run_id"), "scenario")
    return spark.read.parquet(path).where(F.col("run_id") == name)


def list_runs(runs: DataFrame) -> DataFrame:
    """Run names, newest first."""
    return runs.select("run_id").distinct().orderBy(F.col("run_id").desc())


def display_group(name: Column) -> Column:
    """``callout_x`` as ``callout/x``; other names unchanged."""
    return F.when(
        name.startswith("callout_"), F.concat(F.lit("callout/"), F.regexp_replace(name, "^callout_", ""))
    ).otherwise(name)


def read_summary(summary: DataFrame) -> DataFrame:
    """Run summary with dashboard names for the callout groups."""
    return summary.withColumn("group", display_group(F.col("group").cast("string")))


def typed_unique_paths(df: DataFrame) -> DataFrame:
    """Path table with ``incident_count`` as a number (bad text is NULL)."""
    return df.withColumn("incident_count", F.col("incident_count").cast("string").try_cast("bigint"))


def read_unique_paths(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Path table from ``parquet``, or ``csv`` by its headings."""
    return typed_unique_paths(read_incidents(spark, path, fmt=fmt))
