"""Unique paths, filters and drill-through on small tables, checked by brute force."""

import itertools
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from faultline.operators import filters, unique_paths
from faultline.operators.rollups import histogram, pareto
from faultline.operators.common import value_counts

T0 = datetime(2024, 1, 1)


def incidents(spark, rows):
    schema = (
        "number string, opened timestamp_ntz, paths string, description string, configuration_item string, "
        "error_family string, primary_interface string"
    )
    return spark.createDataFrame(rows, schema).repartition(4)


def test_rollup_of_explicit_and_text_paths(spark):
    rows = [
        ("1", T0, "/a//b; /c,/a/b", None, "CI-1", "X", "E1"),
        ("2", T0, " ", "see /a/b. and C:\\d", "CI-2", None, "E2"),
        ("3", T0, None, "see rel/ab", " ", "", "E2"),
        ("1", T0 + timedelta(hours=1), "/a/b", None, "CI-9", "Z", "E9"),
        ("4", T0, "plain", None, None, "Y", None),
    ]
    got = [tuple(r) for r in unique_paths.unique_paths(incidents(spark, rows), lexicon=()).collect()]
    assert got == [
        ("/a/b", 2, "CI-1; CI-2", "X", "E1 (1); E2 (1)"),
        ("/ab", 1, "", "", "E2 (1)"),
        ("/c", 1, "CI-1", "X", "E1 (1)"),
        ("C:\\d", 1, "CI-2", "", "E2 (1)"),
        ("plain", 1, "", "Y", ""),
    ]
    fixed = [r.path for r in unique_paths.unique_paths_fixed(incidents(spark, rows)).collect()]
    assert "plain" not in fixed and "/c" in fixed
    assert [r.path for r in unique_paths.unique_paths(incidents(spark, rows), lexicon=(), min_count=2).collect()] == ["/a/b"]


def test_top_five_interfaces_by_count_then_name(spark):
    counts = {"E7": 3, "E1": 2, "E2": 2, "E3": 1, "E4": 1, "E5": 1, None: 9}
    rows, n = [], itertools.count()
    for iface, k in counts.items():
        rows += [(str(next(n)), T0, "/p", None, None, None, iface) for _ in range(k)]
    row = unique_paths.unique_paths(incidents(spark, rows), lexicon=()).first()
    assert row.top_primary_interfaces == "E7 (3); E1 (2); E2 (2); E3 (1); E4 (1)"
    assert row.incident_count == 19


def test_copies_of_a_pair_keep_the_first_context(spark):
    rows = [("1", T0 + timedelta(hours=h), "/p", None, f"CI-{h}", None, f"E{h}") for h in (3, 1, 2)] * 50
    with_paths = unique_paths.incident_paths(incidents(spark, rows))
    pairs = unique_paths.path_dedup(with_paths)
    assert [tuple(r) for r in pairs.collect()] == [("1", "/p", "CI-1", None, "E1")]
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
    stats = unique_paths.path_scan_stats(with_paths).first()
    assert tuple(stats) == (150, 150, 150)


def test_rank_limit_is_applied_before_the_shuffle(spark):
    rows = [("1", T0, "/p", None, None, None, "E1")]
    pairs = unique_paths.path_dedup(unique_paths.incident_paths(incidents(spark, rows)))
    plan = unique_paths.top_interfaces(pairs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_family_rederivation(spark):
    rows = [(f, d) for f in (None, " ", "KEPT") for d in ("ab cd", "zz", None)]
    df = spark.createDataFrame(rows, "error_family string, description string")
    out = unique_paths.rederive_family(df, ("AB-CD",)).collect()
    assert [r.error_family for r in out] == ["AB-CD", "", "", "AB-CD", "", "", "KEPT", "KEPT", "KEPT"]
    forced = unique_paths.rederive_family(df, ("AB-CD",), force=True).collect()
    assert [r.error_family for r in forced] == ["AB-CD", "", ""] * 3


def drill_rows(spark, rows):
    return spark.createDataFrame(rows, "number string, paths string, short_description string, resolution_notes string")


def brute(rows, path):
    return sum(any(path.lower() in (c or "").lower() for c in r[1:]) for r in rows)


@pytest.mark.parametrize("chars", [1, filters.BLOCK_CHARS])
def test_drill_through_all_equals_comparing_every_pair(spark, chars):
    rnd = random.Random(5)
    pieces = ["/", "//", "/var", "/VAR/x", "var", "\\\\srv\\s", "C:\\", "d:\\a b", " ", ",", ";", ".", "x1", "\n", "é"]
    rows = [
        (str(i), *["".join(rnd.choices(pieces, k=rnd.randrange(9))) if rnd.random() < 0.9 else None for _ in range(3)])
        for i in range(120)
    ]
    paths = ["/", "/var", "/var/x", "/VAR/X", "/var/xvar", "//", "C:\\", "c:\\x1", "d:\\a", "\\\\srv\\s", "\\\\srv\\s.", "/nowhere", "/var.x1"]
    paths += ["var", "x1,", "d:\\a b", "a b;", "é", " ", "VAR", "\n/"]
    table = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {r.path: r.matching_incidents for r in filters.drill_through_all(drill_rows(spark, rows), table, block_chars=30 * chars).collect()}
    assert got == {p: brute(rows, p) for p in paths}
    assert max(got.values()) > 20 and got["/nowhere"] == 0
    for p in ("/var/x", "d:\\a"):
        assert filters.drill_through(drill_rows(spark, rows), p).count() == got[p]


def test_drill_through_all_on_any_text(spark):
    rows = [("1", None, "abc d/e", None), ("2", "bc d", "x\ny", "ABC D"), ("3", None, None, None)]
    table = spark.createDataFrame([("bc d",), ("c",), ("x y",), ("Y",), (None,), ("",), ("in/data/x",), ("c",)], "path string")
    got = sorted((tuple(r) for r in filters.drill_through_all(drill_rows(spark, rows), table).collect()), key=str)
    assert got == sorted([("bc d", 2), ("c", 2), ("c", 2), ("x y", 0), ("Y", 1), (None, 0), ("", 0), ("in/data/x", 0)], key=str)
    assert filters.drill_through_all(drill_rows(spark, []), table).where("matching_incidents > 0").count() == 0


def test_drill_through_all_of_its_siblings_table_and_long_texts(spark):
    """Paths cells are kept as written, relative or with spaces; a text of a megabyte is no obstacle."""
    long_text = "/a/b" * 250_000 + " in/data/x.txt"
    rows = [("1", "in/data/x.txt,/opt/my dir/f", None, None), ("2", None, long_text, "see /opt/my dir/f"), ("3", None, None, "/a/b")]
    table = spark.createDataFrame([("in/data/x.txt",), ("/opt/my dir/f",), ("/a/b",)], "path string")
    got = {r.path: r.matching_incidents for r in filters.drill_through_all(drill_rows(spark, rows), table).collect()}
    assert got == {"in/data/x.txt": 2, "/opt/my dir/f": 2, "/a/b": 2}


def test_drill_through_needs_a_path(spark):
    assert filters.drill_through(drill_rows(spark, [("1", "/a", "/a", "/a")]), "").count() == 0


def test_incident_filters(spark):
    df = spark.createDataFrame(
        [("E1", "X", "PUT", "550", "2024-01", "Monday", 3, "Say Hi", "n"), ("E2", "Y", "get", None, None, None, None, None, "hi")],
        "primary_interface string, error_family string, ftp_command string, ftp_code string, month string, dow string, "
        "hour bigint, short_description string, resolution_notes string",
    )

    def names(**tests):
        return [r.primary_interface for r in filters.filter_incidents(df, **tests).orderBy("primary_interface").collect()]

    assert names() == ["E1", "E2"]
    assert names(interface="E2") == ["E2"] and names(family="X") == ["E1"]
    assert names(ftp_command="GET") == ["E2"] and names(ftp_code="550") == ["E1"]
    assert names(text=" HI ") == ["E1", "E2"] and names(text="hi n") == ["E1"] and names(text=".") == []
    assert names(hours=(0, 23)) == ["E1", "E2"] and names(hours=(3, 3)) == ["E1"] and names(hours=(4, 23)) == []
    assert names(months=["2024-01"], dows=["Monday"]) == ["E1"]
    options = [tuple(r) for r in filters.filter_options(df).collect()]
    assert ("ftp_command", "get") in options and ("month", "2024-01") in options and len(options) == 8


def test_path_filters(spark):
    table = spark.createDataFrame(
        [("/v/a.txt", 5, "CI-1; CI-10", "X", "E1 (2)"), ("/w/a.txt/b", None, "CI-10", None, "")],
        "path string, incident_count bigint, configuration_items string, error_families string, top_primary_interfaces string",
    )

    def hits(**tests):
        return [r.path[1] for r in filters.filter_paths(table, **tests).orderBy("path").collect()]

    assert hits() == ["v", "w"] and hits(path_prefix=" /v") == ["v"] and hits(min_incidents=1) == ["v"]
    assert hits(ci_choice="ci-1") == ["v"] and hits(ci_choice="CI-10") == ["v", "w"] and hits(ci_choice="(any)") == ["v", "w"]
    assert hits(family="x") == ["v"] and hits(family_choice="X") == ["v"] and hits(interface="e1") == ["v"]
    assert hits(file_name="A.TXT") == ["v"] and hits(text="ci-10") == ["v", "w"] and hits(min_incidents=0) == ["v", "w"]
    choices = [tuple(r) for r in filters.joined_choices(table).collect()]
    assert choices == [("configuration_items", "CI-1"), ("configuration_items", "CI-10"), ("error_families", "X")]
    assert [r.path for r in filters.top_paths(table, 1).collect()] == ["/v/a.txt"]


def test_histogram(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 29, 30, 30, None)], "v bigint")
    got = [(r.bin, r.lower, r.upper, r["count"]) for r in histogram(df, "v").collect()]
    assert got == [(0, 0.0, 1.0, 1), (1, 1.0, 2.0, 1), (29, 29.0, 30.0, 3)]
    one = [tuple(r) for r in histogram(df.where("v = 1"), "v").collect()]
    assert one == [(0, 1.0, 1.0, 1)]
    assert histogram(df.where("v is null"), "v").count() == 0


def test_value_counts_and_pareto(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", "b", "c", "a", None, None, None]], "k string")
    assert [tuple(r) for r in value_counts(df, "k").collect()] == [("a", 2), ("b", 2), ("c", 1)]
    assert [tuple(r) for r in value_counts(df, "k", 2, "UNKNOWN", "n").collect()] == [("UNKNOWN", 3), ("a", 2)]
    assert [tuple(r) for r in pareto(df, "k", 2).collect()] == [("a", 2, 50.0), ("b", 2, 100.0)]
    assert pareto(df.where(F.lit(False)), "k").count() == 0


@pytest.mark.parametrize("n", [1, 3, 4, 5, 9, 10, 11, 50])
def test_preview_is_the_head_of_the_sorted_table(spark, n):
    days = [0, 0, 0, 1, 1, 5, 5, 5, None, None]
    rows = [(str(i), None if d is None else T0 + timedelta(days=d, minutes=(i * 7) % 5)) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "number string, opened timestamp_ntz").repartition(4)
    ordered = sorted(rows, key=lambda r: (r[1] is None, r[1] or T0, r[0]))
    assert [tuple(r) for r in filters.preview(df, n=n).collect()] == ordered[:n]
    as_text = df.withColumn("opened", F.coalesce(F.col("opened").cast("string"), F.lit("unread")))
    assert [r.number for r in filters.preview(as_text, n=n).collect()] == [r[0] for r in ordered[:n]]
