"""Scenario tags, helper columns, run tables and their sinks."""

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from faultline.functions import patterns as P
from faultline.operators import fields, scenarios
from faultline.operators import scenario_tables as S
from faultline.operators.common import explode_list
from faultline.plans import queries
from faultline.session import new_table_path
from faultline.sources import readers, sinks

TEXTS = {
    "Number of stuck files in /x": ["stuck-files"],
    "from 3 min": ["stuck-files"],
    "from 0 min : - 0": ["misc"],
    "x : - 2": ["stuck-files"],
    "Stuck files": ["stuck-files"],
    "ftp \n error": ["ftp-errors"],
    "code 550": ["ftp-errors"],
    "Not Connected; Permission denied": ["ftp-errors"],
    "unsuccessful put": ["ftp-errors"],
    "config exists": ["config-file"],
    "FMS-CONFIG-FILE": ["config-file"],
    "cannot MOVE": ["err-file-remove"],
    "callout mfterr03": ["misc"],
    "CALLOUTMFTERR3": ["callout_mfterr03"],
    "callout-mfterr04 then callout_mfterr03": ["callout_mfterr03", "callout_mfterr04"],
    "process-alert": ["process-alert"],
    "warning": ["warnings"],
    "forewarning: x": ["warnings"],
    "WARNING: stuck files :-1 550 process-alert": ["stuck-files", "ftp-errors", "process-alert", "warnings"],
    "": ["misc"],
    None: ["misc"],
}


@pytest.fixture(scope="module")
def tagged(spark):
    rows = [(str(i), datetime(2024, 1, 1), t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "number string, opened timestamp_ntz, short_description string")
    return scenarios.tag_scenarios(fields.ensure_helpers(df))


def test_tags(tagged):
    assert {r.short_description: r.scenarios for r in tagged.collect()} == TEXTS


def test_given_family_labels_count_in_either_spelling(spark):
    df = spark.createDataFrame([("CALLOUT_MFTERR03",), (" callout-mfterr04 ",), (None,)], "error_family string")
    df = df.withColumns({"short_description": F.lit("x"), "number": F.lit("1")})
    out = scenarios.tag_scenarios(fields.ensure_helpers(df, derive=False)).collect()
    assert [r.scenarios for r in out] == [["callout_mfterr03"], ["callout_mfterr04"], ["misc"]]


def test_counts_and_summary(tagged):
    expected = Counter(s for tags in TEXTS.values() for s in tags)
    tall = scenarios.scenario_tall(tagged)
    got = [tuple(r) for r in scenarios.scenario_counts(tall).collect()]
    assert got == [(s, expected[s]) for s in P.SCENARIOS]
    summary = scenarios.partition_summary(tagged).collect()
    assert [(r["group"], r["count"]) for r in summary] == got
    total, misc = len(TEXTS), expected["misc"]
    assert {r.total_rows for r in summary} == {total}
    assert summary[0].coverage_pct == pytest.approx((sum(expected.values()) - misc) / total * 100)
    assert summary[0].coverage_distinct_pct == pytest.approx((total - misc) / total * 100)
    assert [r["group"] for r in readers.read_summary(scenarios.partition_summary(tagged)).collect()][4] == "callout/mfterr03"


def test_empty_input(tagged):
    none = tagged.where(F.lit(False))
    assert [r["count"] for r in scenarios.partition_summary(none).collect()] == [0] * 9
    assert [r["count"] for r in scenarios.scenario_counts(scenarios.scenario_tall(none)).collect()] == [0] * 9
    row = S.run_summary(scenarios.scenario_tall(none)).first()
    assert (row.total_rows, row.coverage_pct, row.pct_error_family_other) == (0, 0.0, 0.0)


def test_misc_samples_in_source_order(tagged):
    got = [r.short_description for r in scenarios.misc_samples(tagged, 2).collect()]
    misc = [(str(i), t) for i, (t, tags) in enumerate(TEXTS.items()) if tags == ["misc"]]
    assert got == [t for _, t in sorted(misc)][:2]
    assert scenarios.misc_samples(tagged, 200).count() == len(misc)


def test_patterns_run_once_for_the_tall_table(tagged):
    plan = scenarios.scenario_tall(tagged).where(F.col("scenario") == "misc")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("contains no config lines") == 1


def test_subgroups_and_run_roundtrip(spark, tagged):
    tall = scenarios.scenario_tall(tagged)
    path = new_table_path(spark, "test-run")
    sinks.write_run(tall, path, "run_1")
    sinks.write_run(tall, path, "run_2")
    back = spark.read.parquet(path)
    assert back.count() == 2 * tall.count()
    assert [r.run_id for r in readers.list_runs(back).collect()] == ["run_2", "run_1"]
    group = readers.read_group(spark, path, "run_1", "callout/mfterr03")
    assert sorted(r.short_description for r in group.collect()) == sorted(t for t, tags in TEXTS.items() if "callout_mfterr03" in tags)
    plan = group._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan
    assert readers.read_group(spark, path, "run_1", "no-such").count() == 0
    assert readers.latest_run(back).select("run_id").distinct().collect()[0][0] == "run_2"
    sub = new_table_path(spark, "test-sub")
    sinks.write_subgroups(tall, sub, "ftp-errors", "ftp_command")
    counts = {r[0]: r[1] for r in spark.read.parquet(sub).groupBy("by_ftp_command").count().collect()}
    assert counts == {"UNKNOWN": 4, "PUT": 1}


def test_hot_folder_is_split_when_written(spark):
    df = spark.range(200_000).select(
        F.col("id").cast("string").alias("number"), F.sha2(F.col("id").cast("string"), 512).alias("text"),
        F.when(F.col("id") % 50 > 0, "misc").otherwise("warnings").alias("scenario"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        path = new_table_path(spark, "test-hot")
        sinks.write_run(df, path, "r")
        files = spark.read.parquet(path).select("scenario", F.input_file_name().alias("f")).distinct()
        counts = {r[0]: r[1] for r in files.groupBy("scenario").count().collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert counts["misc"] > 3 and counts["warnings"] <= counts["misc"]
    assert spark.read.parquet(path).count() == 200_000


def test_helpers_keep_given_values(spark):
    df = spark.createDataFrame([("E001 /var/x", None, "given"), ("E002", 5, None)], "short_description string, stuck_files_count bigint, paths string")
    got = fields.ensure_helpers(df).select("primary_interface", "stuck_files_count", "paths", "has_path").collect()
    assert [tuple(r) for r in got] == [("E001", None, "given", True), ("E002", 5, None, False)]
    plain = fields.ensure_helpers(df, derive=False).first()
    assert (plain.paths, plain.has_path, plain.ftp_code) == ("given", False, None)
    with pytest.raises(ValueError):
        fields.ensure_helpers(df, text_col=None)


def test_explode_keeps_repeats_and_drops_blanks(spark):
    df = spark.createDataFrame([("1", " /a, ,/b,/a "), ("2", None), ("3", "")], "number string, paths string")
    assert [tuple(r) for r in explode_list(df).collect()] == [("1", " /a, ,/b,/a ", "/a"), ("1", " /a, ,/b,/a ", "/b"), ("1", " /a, ,/b,/a ", "/a")]


def test_transfer_tables_in_one_pass_equal_the_three(spark, sf_dir):
    tall = queries.tall(spark, sf_dir)
    one = {(r.table, r.primary_interface, r.ftp_command, r.ftp_code): r.incidents_count for r in S.ftp_tables(tall).collect()}
    for r in S.ftp_by_verb(tall).collect():
        assert one.pop(("by_verb", None, r.ftp_command, None)) == r.incidents_count
    for r in S.ftp_by_code(tall).collect():
        assert one.pop(("by_code", None, None, r.ftp_code)) == r.incidents_count
    for r in S.ftp_iface_verb_code(tall).collect():
        assert one.pop(("by_interface_verb_code", r.primary_interface, r.ftp_command, r.ftp_code)) == r.incidents_count
    assert not one


def test_tables_without_host_column_are_empty(tagged):
    tall = scenarios.scenario_tall(tagged)
    assert S.warnings_hosts(tall).columns == ["host_tag", "incidents_count"] and S.warnings_hosts(tall).count() == 0
    assert S.callout_hosts(tall).count() == 0
    assert S.callout_interfaces(tall, "callout_mfterr03").columns == ["primary_interface", "incidents_count"]


def test_results_do_not_depend_on_partitioning(spark, sf_dir):
    from faultline.plans.fixtures import incidents

    df = incidents(spark, sf_dir)
    outcomes = []
    for parts in (1, 13):
        tagged = scenarios.tag_scenarios(fields.ensure_helpers(df.repartition(parts, F.rand(parts))))
        tall = scenarios.scenario_tall(tagged)
        outcomes.append([S.top_offenders(tall).collect(), S.stuck_paths_stats(tall).collect(), S.misc_top_tokens(tall).collect()])
    assert outcomes[0] == outcomes[1]


def test_all_tables_of_a_stored_run(spark, sf_dir, tmp_path):
    """Written from the stored run they equal those from the rows, and the scan is pruned by scenario."""
    rows = queries.tall(spark, sf_dir).cache()
    sinks.write_run(rows, f"{tmp_path}/runs", "r1")
    sinks.write_run(rows.limit(5), f"{tmp_path}/runs", "r0")
    assert readers.run_names(spark, f"{tmp_path}/runs") == ["r1", "r0"]
    run = readers.read_run(spark, f"{tmp_path}/runs")
    names = S.write_run_tables(run, f"{tmp_path}/tables")
    assert len(names) == 22
    for name in names:
        back = spark.read.parquet(f"{tmp_path}/tables/{name}").collect()
        assert sorted(map(str, back)) == sorted(map(str, S.RUN_TABLES[name](rows).collect())), name
    plan = S.ftp_by_verb(run)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "scenario" in plan.split("PartitionFilters: [")[1].split("]")[0]
    rows.unpersist()
