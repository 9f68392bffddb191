"""Scenario tagging: overlapping failure groups as an array, exploded for the tall form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import has_match, rx, strip_ws
from .common import constant_table, with_lists_exploded
from .filters import preview


def _scenario_tests(text: Column) -> dict[str, Column]:
    family = F.upper(strip_ws(F.coalesce(F.col("error_family"), F.lit(""))))
    tests = {}
    for name, (label, pattern) in P.SCENARIO_RULES.items():
        # Either spelling of a label counts: tables written elsewhere may use "_".
        tests[name] = (F.translate(family, "_", "-") == label) | has_match(text, pattern, ignore_case=True)
    count = F.coalesce(F.col("stuck_files_count").cast("string").try_cast("double"), F.lit(0.0))
    minutes = F.coalesce(F.col("stuck_for_minutes").cast("string").try_cast("double"), F.lit(0.0))
    tests["stuck-files"] = tests["stuck-files"] | (count >= 1) | (minutes >= 1)
    code = F.coalesce(F.col("ftp_code").cast("string").rlike(rx(P.FTP_CODE_550)), F.lit(False))
    verb = F.coalesce(F.upper(F.col("ftp_command")).isin("PUT", "GET"), F.lit(False))
    tests["ftp-errors"] = tests["ftp-errors"] | code | verb
    return tests


def tag_scenarios(df: DataFrame, text_col: str = "short_description") -> DataFrame:
    """Append ``scenarios``: every matching scenario in reported order, else ``['misc']``.

    Needs the helper columns (:func:`~faultline.operators.fields.ensure_helpers`).
    """
    tests = _scenario_tests(F.col(text_col))
    tags = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()]))
    return df.withColumn("_tags", tags).withColumn(
        "scenarios", F.when(F.size("_tags") > 0, F.col("_tags")).otherwise(F.array(F.lit("misc")))
    ).drop("_tags")


def scenario_tall(tagged: DataFrame) -> DataFrame:
    """One row per (incident, scenario), from one scan."""
    return with_lists_exploded(tagged, "scenarios", "scenario")


def scenario_counts(tall: DataFrame) -> DataFrame:
    """``group, count`` of all nine scenarios in reported order, zeros kept."""
    counted = tall.groupBy("scenario").agg(F.count(F.lit(1)).alias("n"))
    return (
        constant_table(tall, "scenario", P.SCENARIOS)
        .join(counted, "scenario", "left")
        .orderBy("position")
        .select(F.col("scenario").alias("group"), F.coalesce("n", F.lit(0)).alias("count"))
    )


def partition_summary(tagged: DataFrame) -> DataFrame:
    """Count per scenario with run totals.

    ``coverage_pct`` sums overlapping groups and may pass 100;
    ``coverage_distinct_pct`` counts each incident once. One pass: every counter
    is a conditional sum over the tagged rows, then turned into rows.
    """
    has = [F.sum(F.array_contains("scenarios", s).cast("bigint")).alias(s) for s in P.SCENARIOS]
    totals = tagged.agg(F.count(F.lit(1)).alias("total_rows"), *has)
    named = [c for c in P.SCENARIOS if c != "misc"]
    covered = sum((F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in named), F.lit(0))
    total = F.col("total_rows")
    pct = F.when(total > 0, covered / total * 100.0).otherwise(0.0)
    distinct_pct = F.when(total > 0, (total - F.col("misc")) / total * 100.0).otherwise(0.0)
    cells = F.array(
        *[
            F.struct(F.lit(s).alias("group"), F.coalesce(F.col(f"`{s}`"), F.lit(0)).alias("count"))
            for s in P.SCENARIOS
        ]
    )
    return totals.select(
        F.inline(cells), "total_rows", pct.alias("coverage_pct"), distinct_pct.alias("coverage_distinct_pct")
    )


def misc_samples(tagged: DataFrame, n: int = 200, order: tuple[str, ...] = ("opened", "number")) -> DataFrame:
    """First ``n`` unmatched incidents by opening time, then number, unread times last, for rule review."""
    misc = scenario_tall(tagged).where(F.col("scenario") == "misc").drop("scenario")
    first, *rest = order
    return preview(misc, first, rest, n)
