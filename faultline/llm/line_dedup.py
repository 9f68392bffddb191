"""Exact line deduplication across documents, with DataFrame functions only.

Line hashes are range-partitioned and sorted by document and position inside; a
running ``first`` streams over them, so a line learns the first document holding it
without any group being buffered. A hash found in very many documents is cut into
``salts`` ranges by document; only the first document of each range goes on to the
second stream, which finds the first of all. Rows already known to be later
occurrences travel under a key of their own, spread evenly. What returns is one row
per document with the run-length compressed bitmap of its kept lines.

Defined cases: NULL or empty text is one empty line. A NULL id sorts after all
others; rows that share an id are one document, each row with its own bitmap, and
equal rows give equal results. A line shorter than ``least_chars`` is always kept,
as are all lines of the first document holding it. Only the id and text columns
are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, UPPER.lower())


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _first(spec_keys: list[str]) -> Column:
    order = [F.col("id").asc_nulls_last(), F.col("pos").asc()]
    frame = Window.partitionBy(*spec_keys).orderBy(*order)
    return F.first("id").over(frame.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def keep_bitmaps(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 10, salts: int = 64
) -> DataFrame:
    """Rows with dropped lines: ``id``, ``row`` (hash of the text), ``dropped`` (ascending line numbers from 0)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    lines = (
        rows.select("id", F.xxhash64("text").alias("row"), F.posexplode(text_lines(F.col("text"))).alias("pos", "line"))
        .withColumn("key", line_key(F.col("line")))
        .where(F.length("key") >= least_chars)
        .select(
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(7), "key").alias("h2"),
            F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt"),
            "id",
            "row",
            "pos",
        )
    )
    ranged = lines.repartitionByRange("h1", "h2", "salt").withColumn("lead", _first(["h1", "h2", "salt"]))
    open_ = ranged.select(
        F.col("id").eqNullSafe(F.col("lead")).alias("open"), "h1", "h2", "id", "row", "pos"
    ).withColumns(
        {
            "k1": F.when(F.col("open"), F.col("h1")).otherwise(F.xxhash64("h1", "id", "row", "pos")),
            "k2": F.when(F.col("open"), F.col("h2")).otherwise(F.lit(0)),
        }
    )
    judged = open_.select("open", "k1", "k2", "id", "row", "pos").withColumn("lead", _first(["open", "k1", "k2"]))
    later = judged.where(~F.col("open") | ~F.col("id").eqNullSafe(F.col("lead")))
    return later.groupBy("id", "row").agg(F.array_sort(F.collect_set("pos")).alias("dropped"))


def keep_runs(dropped: Column, n_lines: Column) -> Column:
    """Run-length form of the keep bitmap: ``array<struct<start, len>>`` of kept stretches."""

    def run(i: Column) -> Column:
        start = F.when(i == 0, 0).otherwise(F.get(dropped, i - 1) + 1)
        end = F.coalesce(F.get(dropped, i), n_lines)
        return F.struct(start.alias("start"), (end - start).alias("len"))

    runs = F.transform(F.sequence(F.lit(0), F.size(dropped)), run)
    return F.filter(runs, lambda r: r["len"] > 0)


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with ``keep_bitmap``, ``n_lines``, ``n_dropped`` and ``kept_text`` in struct ``lines``; no row is lost.

    The struct's name is the only one that could clash; a column ``lines`` of the input is replaced.
    """
    bitmaps = keep_bitmaps(docs, id_col=id_col, text_col=text_col, **options).select(
        F.col("id").alias("_dedup_id"), F.col("row").alias("_dedup_row"), F.col("dropped").alias("_dropped")
    )
    joined = docs.join(
        bitmaps,
        docs[id_col].eqNullSafe(bitmaps["_dedup_id"]) & (F.xxhash64(docs[text_col]) == bitmaps["_dedup_row"]),
        "left",
    )
    split = text_lines(F.col(text_col))
    none = F.array().cast("array<int>")
    joined = joined.withColumn("_split", split).withColumn(
        "_runs", keep_runs(F.coalesce("_dropped", none), F.size("_split"))
    )
    kept = F.when(F.col("_dropped").isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(
        F.array_join(F.flatten(F.transform("_runs", lambda r: F.slice("_split", r["start"] + 1, r["len"]))), "\n")
    )
    result = F.struct(
        F.col("_runs").alias("keep_bitmap"),
        F.size("_split").cast("long").alias("n_lines"),
        F.size(F.coalesce("_dropped", none)).cast("long").alias("n_dropped"),
        kept.alias("kept_text"),
    )
    return joined.withColumn("lines", result).drop("_dedup_id", "_dedup_row", "_dropped", "_split", "_runs")
