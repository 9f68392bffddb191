"""Readers, sinks, schema handling, enrichment inputs and streaming use."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from faultline.functions import patterns as P
from faultline.functions import times
from faultline.operators import enrich, fields, rollups, scenarios
from faultline.plans.fixtures import incidents
from faultline.session import new_table_path, remove_scratch, shared_folder, written
from faultline.sources import readers, schema, sinks


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def put(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def test_csv_scan(spark, folder):
    head = ",".join(schema.INCIDENT_COLUMNS)
    row = 'INC1,45000.5,Bob,"line one\nsaid ""hi"", /a","",   ,c,1,Closed,G,,n,'
    path = put(folder, "in.csv", f"{head}\n{row}\n")
    got = schema.normalize_schema(readers.read_incidents(spark, path, fmt="csv")).first()
    assert got.short_description == 'line one\nsaid "hi", /a'
    assert (got.description, got.comments, got.assigned_to, got.configuration_item) == (None, "   ", None, None)
    assert got.opened == "45000.5"


def test_csv_columns_go_by_their_headings(spark, folder):
    """Shuffled headings, files in different order, an absent optional column, a folder of parts."""
    os.mkdir(f"{folder}/tickets")
    put(f"{folder}/tickets", "a.csv", "Number,Caller,Short description,Opened\n1,Bob,stuck,2024-01-02\n")
    put(f"{folder}/tickets", "b.csv", "Opened,Comments,short  DESCRIPTION,Number,Caller\n2024-01-03,note,other,2,Eve\n")
    put(f"{folder}/tickets", "c.csv", "Number,Caller,Short description,Opened\n")
    df = readers.read_incidents(spark, f"{folder}/tickets", fmt="csv")
    got = {r.number: (r.caller, r.short_description, r.opened, r.comments) for r in df.collect()}
    assert got == {"1": ("Bob", "stuck", "2024-01-02", None), "2": ("Eve", "other", "2024-01-03", "note")}
    assert readers.read_incidents(spark, f"{folder}/tickets/a.csv", fmt="csv", headings="first").first().caller == "Bob"
    with pytest.raises(Exception, match="CSV header|header"):
        readers.read_incidents(spark, f"{folder}/tickets", fmt="csv", headings="first").collect()
    for bad in ({"fmt": "xlsx"}, {"fmt": "csv", "headings": "none"}):
        with pytest.raises(ValueError):
            readers.read_incidents(spark, f"{folder}/tickets", **bad)


def test_opening_times_in_other_formats(spark):
    rows = ["01/02/2024 10:00", "22-Dec-2025 19:22", "2024/01/02", "31/02/2024 10:00", " 1/2/2024 9:05 ", "45000.5", "2024-01-02", "12-Zzz-2024 10:00", None, ""]
    df = spark.createDataFrame([(r,) for r in rows], "opened string")

    def read(*formats):
        c = times.parse_opened(F.col("opened"), formats).cast("string")
        return [r[0] for r in df.select(c).collect()]

    day_first = read("dd/MM/yyyy HH:mm", "dd-MMM-yyyy HH:mm", "yyyy/MM/dd")
    assert day_first[:4] == ["2024-02-01 10:00:00", "2025-12-22 19:22:00", "2024-01-02 00:00:00", None]
    assert day_first[4:] == ["2024-02-01 09:05:00", "2023-03-15 12:00:00", "2024-01-02 00:00:00", None, None, None]
    assert read("MM/dd/yyyy HH:mm")[0] == "2024-01-02 10:00:00" and read()[0] is None
    assert tuple(enrich.unread_opened(df, formats=["dd/MM/yyyy HH:mm"]).first()) == (10, 5, 1)


def test_order_of_lines_over_files(spark, folder):
    """The smaller file comes first by name, though Spark packs the larger one first."""
    os.mkdir(f"{folder}/ci")
    head = "CI,CI_role,CI_protocol,CI_env,CI_techstack,CI_criticality\n"
    put(f"{folder}/ci", "a.csv", head + "A,first,p,e,t,1\n")
    put(f"{folder}/ci", "b.csv", head + "B,r,p,e,t,1\n" * 50 + "A,last,p,e,t,1\n")
    last = {r.ci: r.ci_role for r in enrich.last_per_ci(readers.read_ci_lookup(spark, f"{folder}/ci")).collect()}
    assert last == {"A": "last", "B": "r"}
    os.mkdir(f"{folder}/lexicon")
    put(f"{folder}/lexicon", "1.txt", "first\n")
    put(f"{folder}/lexicon", "2.txt", "second\nfirst\n" + "third\n" * 50)
    assert readers.lexicon_names(readers.read_lexicon(spark, f"{folder}/lexicon")) == ["first", "second", "third"]
    with pytest.raises(ValueError, match="line_no"):
        enrich.last_per_ci(readers.read_ci_lookup(spark, None).drop("line_no"))


def test_a_run_written_again_leaves_no_old_group(spark, folder):
    df = spark.createDataFrame([(1, "misc"), (2, "stuck-files")], "id int, scenario string")
    sinks.write_run(df, folder + "/runs", "r1")
    sinks.write_run(df, folder + "/runs", "r2")
    sinks.write_run(df.where("id = 2"), folder + "/runs", "r1")
    got = {(r.run_id, r.scenario) for r in spark.read.parquet(folder + "/runs").collect()}
    assert got == {("r1", "stuck-files"), ("r2", "misc"), ("r2", "stuck-files")}
    assert sorted(x for x in os.listdir(folder + "/runs")) == ["run_id=r1", "run_id=r2"]


def test_given_helpers_as_a_csv_writes_them(spark):
    df = spark.createDataFrame([("3.0", "x"), ("bad", "y"), (None, "z")], "stuck_files_count string, short_description string")
    assert [r.stuck_files_count for r in fields.ensure_helpers(df.withColumn("stuck_files_count", F.col("stuck_files_count"))).collect()] == [3, None, None]
    tagged = scenarios.tag_scenarios(fields.ensure_helpers(df).withColumn("stuck_for_minutes", F.lit("many")))
    assert [("stuck-files" in r.scenarios) for r in tagged.collect()] == [True, False, False]


def test_table_roundtrips(spark, folder):
    df = spark.createDataFrame([("a\"b", "x\ny", 1), (None, " p ", None)], "a string, b string, n bigint")
    sinks.write_table(df, f"{folder}/t.csv", "csv")
    assert sorted(readers.read_csv(spark, f"{folder}/t.csv", df.schema).collect(), key=str) == sorted(df.collect(), key=str)
    sinks.write_table(df, f"{folder}/p", partition_by=("n",))
    assert spark.read.parquet(f"{folder}/p").count() == 2
    with pytest.raises(ValueError):
        sinks.write_table(df, f"{folder}/x", "xlsx")


def test_sheet_choice(spark):
    df = spark.createDataFrame([(s,) for s in ("b", "a", "data", "a")], "source_sheet string")

    def chosen(*args, **kw):
        return {r[0] for r in readers.select_sheet(df, *args, **kw).collect()}

    assert chosen() == chosen("first") == chosen("") == chosen(0) == {"a"}
    assert chosen(1) == chosen("1") == {"b"} and chosen(" data ") == {"data"}
    for bad in ("zz", 7):
        with pytest.raises(ValueError):
            readers.select_sheet(df, bad)
    assert chosen("zz", strict=False) == chosen(None, strict=False) == {"data"}
    assert chosen("b", strict=False) == {"b"}
    assert chosen(sheets=["b", "a"]) == {"b"} and chosen(1, sheets=["b", "a"]) == {"a"}
    assert {r[0] for r in readers.select_sheet(df.where("source_sheet != 'data'"), "zz", strict=False).collect()} == {"a"}


def test_sheet_union(spark):
    one, two = spark.range(1).withColumn("x", F.lit("p")), spark.range(2)
    got = readers.union_sheets({"s1": one, "s2": two})
    assert sorted(tuple(r) for r in got.select("source_sheet", "id", "x").collect()) == [("s1", 0, "p"), ("s2", 0, None), ("s2", 1, None)]
    assert readers.union_sheets({"s1": one, "s2": two}, tag=False).columns == ["id", "x"]
    with pytest.raises(ValueError):
        readers.union_sheets({})


def test_lexicon_file(spark, folder):
    path = put(folder, "families.txt", "  B fam \n\nA-FAM\r\nB fam\n   \nC\n")
    assert readers.lexicon_names(readers.read_lexicon(spark, path)) == ["B fam", "A-FAM", "C"]
    assert readers.lexicon_names(readers.read_lexicon(spark, f"{folder}/none.txt")) == []
    assert readers.read_lexicon(spark, None).count() == 0


def test_ci_lookup_last_line_wins_and_bad_files(spark, folder):
    head = "CI,CI_role,CI_protocol,CI_env,CI_techstack,CI_criticality\n"
    path = put(folder, "ci.csv", head + "A,z,p,e,t,1\nB,r,,e,t,2\nA,a,q,f,u,3\n")
    lookup = readers.read_ci_lookup(spark, path)
    df = spark.createDataFrame([("A",), ("C",), (None,), ("A",)], "configuration_item string")
    got = sorted((tuple(r) for r in enrich.join_ci(df, lookup).select("ci", *enrich.CI_ATTRIBUTES).collect()), key=str)
    a = ("A", "a", "q", "f", "u", "3")
    assert got == [a, a, ("C", *[None] * 5), (None, *[None] * 5)]
    assert readers.read_ci_lookup(spark, put(folder, "head.csv", head)).count() == 0
    assert readers.read_ci_lookup(spark, f"{folder}/absent.csv").count() == 0
    assert readers.read_ci_lookup(spark, None).count() == 0
    with pytest.raises(ValueError, match="CI_env"):
        readers.read_ci_lookup(spark, put(folder, "bad.csv", head.replace("CI_env,", "")))


def test_schema(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`short DESCRIPTION ` int, `Shortdescription` int, ` Other ` int")
    out = schema.resolve_columns(df)
    assert out.columns == ["short_description", "Other"] and out.first()[0] == 1
    assert schema.find_column(df, "OTHER") == " Other " and schema.find_column(df, "none") is None
    with pytest.raises(ValueError, match="number"):
        schema.normalize_schema(df)
    filled = schema.null_fill(df, ["n"], "bigint")
    assert dict(filled.dtypes)["n"] == "bigint" and schema.null_fill(df, []) is df


def test_unique_paths_table_types(spark, folder):
    path = put(folder, "u.csv", "path,incident_count,configuration_items,error_families,top_primary_interfaces\n/a,3,x,,\n/b,bad,,,\n")
    assert [(r.path, r.incident_count) for r in readers.read_unique_paths(spark, path, fmt="csv").collect()] == [("/a", 3), ("/b", None)]


def test_enrich_end_to_end(spark, sf_dir):
    df = incidents(spark, sf_dir)
    out = enrich.enrich(df, opened="opened_raw")
    readable = df.where("opened_raw != 'not a date'").count()
    assert out.count() == readable
    assert set(enrich.CI_ATTRIBUTES) | {"prev_time", "recurs_24h", "daypart", "error_anomalies_unmatched"} <= set(out.columns)
    assert out.where("recurs_24h and (prev_time is null or opened_dt > prev_time + interval 24 hours)").count() == 0
    assert enrich.with_opened_dt(df).count() == df.count()
    row = rollups.quality_checks(out.where("false")).first()
    assert tuple(row) == (0.0, 0.0, 0, 0, 0.0)
    assert rollups.kpis(out.where("false")).first().total_incidents == 0


def test_unknown_profiles_are_refused(spark, sf_dir):
    df = incidents(spark, sf_dir)
    for call in (lambda: fields.extract_fields(df, "description", "v9"), lambda: fields.extract_features(df, "v1")):
        with pytest.raises(ValueError):
            call()


def test_days_without_rows(spark):
    df = spark.createDataFrame([("1", "Monday", 3), ("2", "Monday", 3), ("3", None, None)], "number string, dow string, hour bigint")
    counts = {r.dow: r["count"] for r in rollups.dow_counts(df).collect()}
    assert counts["Monday"] == 2 and counts["Sunday"] is None and len(counts) == 7
    zero = {r.dow: r for r in rollups.dow_hour_matrix(df).collect()}
    null = {r.dow: r for r in rollups.dow_hour_matrix(df, absent_days_null=True).collect()}
    assert (zero["Monday"].h03, zero["Monday"].h04, zero["Sunday"].h03) == (2, 0, 0)
    assert (null["Monday"].h04, null["Sunday"].h03) == (0, None)


def test_shared_folder(spark, folder):
    assert shared_folder(spark)
    assert new_table_path(spark, "x") != new_table_path(spark, "x")
    table = written(spark.range(10), "ids")
    assert table.count() == 10
    kept = [f.removeprefix("file://") for f in table.inputFiles()]
    assert all(map(os.path.exists, kept))
    remove_scratch(spark)
    assert not any(map(os.path.exists, kept))


def test_row_operators_run_on_a_stream(spark, sf_dir, folder):
    batch = incidents(spark, sf_dir).select("number", "opened", "opened_raw", "short_description").coalesce(1)
    source = f"{folder}/in"
    batch.write.parquet(source)

    def tall(df):
        tagged = scenarios.tag_scenarios(fields.ensure_helpers(enrich.with_opened_dt(df, "opened_raw")))
        return scenarios.scenario_tall(tagged).select("number", "scenario")

    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    run = (
        tall(stream).writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
    )
    run.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(f"{folder}/out").collect())
    assert got == sorted(tuple(r) for r in tall(batch).collect())


def test_pattern_tables_are_consistent():
    assert set(P.SCENARIO_RULES) | {"misc"} == set(P.SCENARIOS)
    assert len(P.FAMILY_LEXICON) == 20 and datetime.fromisoformat(P.SERIAL_DAY_ORIGIN)


def test_heading_lines_are_read_as_the_csv_reader_reads_them(spark, folder):
    for k, line in enumerate(['a,b', '"a, x",b', 'a,,A,b', '"q ""x""",  b ', "a"]):
        path = put(folder, f"h{k}.csv", f"{line}\n1,2,3,4\n")
        want = spark.read.options(**readers.CSV_OPTIONS).csv(path).columns
        assert readers.heading_names(line) == want
    assert readers.heading_names('"a\n'.strip()) is None


def test_catalogue_of_headings_over_many_files(spark, folder):
    os.mkdir(f"{folder}/many files")
    for k in range(30):
        names = ["Number", "Status", "Caller"] if k % 3 else ["caller", "NUMBER", '"sta\ntus"']
        row = {"number": f"n{k}", "caller": f"c{k}", "status": f"s{k}", '"sta\ntus"': f"s{k}"}
        put(f"{folder}/many files", f"{k:02}.csv", ("\n" if k == 4 else "") + ",".join(names) + "\n" + ",".join(row[n.lower()] for n in names) + "\n")
    groups = readers.csv_headings(spark, f"{folder}/many files")
    assert sorted(len(files) for _, files in groups) == [10, 20]
    got = readers.read_csv_by_heading(spark, f"{folder}/many files").select("number", "caller", "status").collect()
    assert sorted(tuple(r) for r in got) == sorted((f"n{k}", f"c{k}", f"s{k}") for k in range(30))


def test_ci_lookup_goes_by_the_heading_of_each_file(spark, folder):
    os.mkdir(f"{folder}/cis")
    put(f"{folder}/cis", "1.csv", "CI,CI_role,CI_protocol,CI_env,CI_techstack,CI_criticality\na,ra,pa,ea,ta,1\nb,rb,pb,eb,tb,2\n")
    put(f"{folder}/cis", "2.csv", "ci_criticality,CI_env,CI_techstack,CI_protocol, CI_ROLE ,CI,more\n3,ec,tc,pc,rc,a,x\n")
    got = {r.ci: tuple(r) for r in enrich.last_per_ci(readers.read_ci_lookup(spark, f"{folder}/cis")).collect()}
    assert got == {"a": ("a", "rc", "pc", "ec", "tc", "3"), "b": ("b", "rb", "pb", "eb", "tb", "2")}


def test_numbered_counts_over_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("id")).repartition(7)
    assert [(r.id, r.position) for r in readers.numbered(df, "id").orderBy("id").collect()] == [(k, k) for k in range(1000)]


@pytest.mark.parametrize("failing", [1, 2])
def test_a_run_stays_readable_when_its_replacement_fails(spark, folder, monkeypatch, failing):
    old = spark.createDataFrame([(1, "misc"), (2, "warnings")], "id long, scenario string")
    new = spark.createDataFrame([(3, "misc")], "id long, scenario string")
    path = f"{folder}/runs"
    sinks.write_run(old, path, "r")
    renamed, calls = sinks._renamed, []

    def fail(*args):
        calls.append(args)
        if len(calls) == failing:
            raise OSError("lost")
        renamed(*args)

    with monkeypatch.context() as m:
        m.setattr(sinks, "_renamed", fail)
        with pytest.raises(OSError):
            sinks.write_run(new, path, "r")
    assert readers.run_names(spark, path) == ["r"]
    back = readers.read_run(spark, path)
    assert back.columns == ["id", "run_id", "scenario"]
    assert sorted(tuple(r) for r in back.collect()) == [(1, "r", "misc"), (2, "r", "warnings")]
    assert [r.id for r in readers.read_group(spark, path, "r", "warnings").collect()] == [2]
    sinks.write_run(new, path, "r")
    assert [tuple(r) for r in readers.read_run(spark, path).collect()] == [(3, "r", "misc")]


def test_quality_checks_equal_those_of_row_by_row_recurrence(spark):
    import random

    from faultline.operators.recurrence import add_recurrence

    rng = random.Random(6)
    times = [datetime(2024, 1, 1 + rng.randint(0, 9), rng.randint(0, 23), rng.choice([0, 0, 30]), 0) for _ in range(60)]
    rows = [
        (f"n{i}", rng.choice(["E1", "E2", None]), rng.choice(["a", "other", None]), rng.choice([*times, None]), rng.random() < 0.4, None, i % 3 or None)
        for i in range(400)
    ]
    schema_ = "number string, primary_interface string, error_family string, opened_dt timestamp_ntz, is_intermittent boolean, stuck_files_count long, stuck_for_minutes long"
    df = spark.createDataFrame(rows, schema_)
    got = rollups.quality_checks(df).first()
    full = add_recurrence(df).collect()
    glitches = [r for r in full if r.is_intermittent]
    assert got.intermittent_with_recurrence_ratio == pytest.approx(sum(r.recurs_24h for r in glitches) / len(glitches))
    assert got.pct_no_interface == pytest.approx(sum(r.primary_interface is None for r in full) / 400)
    assert got.pct_other_error_family == pytest.approx(sum(r.error_family == "other" for r in full) / 400)
    assert (got.rows_with_stuck_files_count, got.rows_with_stuck_for_minutes) == (0, sum(r[6] is not None for r in rows))
    plan = rollups.quality_checks(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") == 1
