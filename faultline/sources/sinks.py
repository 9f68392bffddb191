"""Sinks: CSV and Parquet tables, scenario-partitioned runs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from .readers import CSV_OPTIONS, SET_ASIDE


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    """One table as ``parquet`` or ``csv`` (with header; NULL and ``''`` both as an empty cell)."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        options = {k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"}
        writer.options(**options).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def or_unknown(c: Column) -> Column:
    return F.coalesce(c, F.lit(P.UNKNOWN))


def _replace_runs(written: DataFrame, path: str, staged: str) -> None:
    """Move each run folder below ``staged`` to ``path`` in place of the run of that name.

    The old run is set aside under a hidden name first and deleted last. Whatever step
    fails, readers find either the new run or the one set aside.
    """
    spark = written.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target, source = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(staged)
    files = target.getFileSystem(conf)
    for status in files.listStatus(source):
        run = status.getPath()
        if status.isDirectory():
            place = jvm.org.apache.hadoop.fs.Path(target, run.getName())
            aside = jvm.org.apache.hadoop.fs.Path(target, SET_ASIDE + run.getName())
            if files.exists(place):
                files.delete(aside, True)
                _renamed(files, place, aside)
            _renamed(files, run, place)
            files.delete(aside, True)
    files.delete(source, True)


def _renamed(files, source, target) -> None:
    if not files.rename(source, target):
        raise OSError(f"cannot rename {source} to {target}")


def write_run(tall: DataFrame, path: str, run_id: str | None = None, max_records: int = 2_000_000) -> None:
    """Tall scenario table as ``run_id=/scenario=`` folders; a run of the same name is replaced whole, others stay.

    The run is written beside its place and moved there when it is complete, so a
    scenario without rows now leaves none from before, and readers always find a whole run.

    Rows are rebalanced by folder: adaptive execution splits a dominant scenario
    over as many tasks as its size asks for and merges the rare ones, so neither
    one huge file nor one file per input task is written.
    """
    df = tall if run_id is None else tall.withColumn("run_id", F.lit(run_id))
    staged = f"{path.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    (
        df.hint("rebalance", "run_id", "scenario")
        .write.option("maxRecordsPerFile", max_records)
        .partitionBy("run_id", "scenario")
        .parquet(staged)
    )
    _replace_runs(df, path, staged)


def write_subgroups(tall: DataFrame, path: str, scenario: str, key: str, max_records: int = 2_000_000) -> None:
    """Rows of one scenario in one folder per value of ``key``, NULL as ``UNKNOWN``.

    The original column is kept; the folder column is ``by_<key>``. Rebalanced
    like :func:`write_run`, because ``UNKNOWN`` may hold most rows.
    """
    folder = f"by_{key}"
    rows = tall.where(F.col("scenario") == scenario).withColumn(folder, or_unknown(F.col(key)))
    (
        rows.hint("rebalance", folder)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records)
        .partitionBy(folder)
        .parquet(path)
    )
