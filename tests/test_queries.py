"""Every registered query against its SQL, and the driver contract."""

import json

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from faultline.plans import oracles, queries

ORACLES = oracles.oracle_sql()
NAMES = sorted(queries.queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(name, spark, sf_dir, con):
    assert difference(queries.queries()[name](spark, sf_dir), con, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(NAMES) == set(ORACLES)


def test_summary_json_agrees_with_its_parts(spark, sf_dir):
    document = json.loads(queries.queries()["summary_json"](spark, sf_dir).first()[0])
    row = queries.queries()["run_summary"](spark, sf_dir).first()
    assert document["total_rows"] == row.total_rows
    assert document["coverage_pct"] == row.coverage_pct
    assert ";".join(f"{k}={v}" for k, v in document["group_counts"].items()) == row.group_counts
    top = [(r.primary_interface, r.incidents_count) for r in queries.queries()["top_offenders"](spark, sf_dir).collect()]
    got = [(d["primary_interface"], d["incidents_count"]) for d in document["top_offenders_interfaces"]]
    assert got == top


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_ordered_results_come_in_reported_order(spark, sf_dir):
    q = queries.queries()
    counts = [r["count"] for r in q["top_interfaces"](spark, sf_dir).collect()]
    assert counts == sorted(counts, reverse=True) and len(counts) == 15
    assert [r.dow for r in q["dow_counts"](spark, sf_dir).collect()][:2] == ["Monday", "Tuesday"]
    assert [r["group"] for r in q["scenario_counts"](spark, sf_dir).collect()][0] == "stuck-files"
    shares = [r.cum_pct for r in q["error_family_pareto"](spark, sf_dir).collect()]
    assert shares == sorted(shares) and shares[-1] == pytest.approx(100.0)
    paths = [(-r.incident_count, r.path) for r in q["unique_paths"](spark, sf_dir).collect()]
    assert paths == sorted(paths)


@pytest.mark.parametrize("name", ["recurrence", "unique_paths", "stuck_paths_stats", "drill_through_all", "ci_join"])
def test_no_nested_loop_or_cartesian_join(name, spark, sf_dir):
    plan = queries.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = queries.queries()["monthly_trend"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert "event_type" not in schema and "event_id" in schema
