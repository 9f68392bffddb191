"""Recurrence against a plain walk over the sorted incidents."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from faultline.operators.recurrence import add_recurrence, recurrence_pairs

SCHEMA = "primary_interface string, error_family string, opened_dt timestamp_ntz, number string"
T0 = datetime(2024, 1, 1, 23, 59, 59)
DAY = timedelta(hours=24)


def walk(rows):
    """(row, previous time, recurs) by definition."""
    out, last = [], {}
    for r in sorted(rows, key=lambda r: (r[2], r[3])):
        key = (r[0], r[1])
        prev = last.get(key) if None not in key else None
        out.append((*r, prev, prev is not None and r[2] - prev <= DAY))
        last[key] = r[2]
    return Counter(out)


def run(spark, rows, partitions=5):
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    return Counter(tuple(r) for r in add_recurrence(df).collect())


def test_limits_of_the_window(spark):
    us = timedelta(microseconds=1)
    rows = [
        ("E1", "a", T0, "1"), ("E1", "a", T0 + DAY, "2"), ("E1", "a", T0 + 2 * DAY + us, "3"),
        ("E1", "b", T0, "4"), (None, "a", T0, "5"), (None, "a", T0, "6"), ("E2", None, T0, "7"), ("E2", None, T0, "8"),
    ]
    got = run(spark, rows)
    assert got == walk(rows)
    flags = {r[3]: r[5] for r in got}
    assert flags == {"1": False, "2": True, "3": False, "4": False, "5": False, "6": False, "7": False, "8": False}


def test_slice_edges_and_long_gaps(spark):
    steps = [0, 1, 3599, 3600, 3601, 7200, 86400, 86400 * 40, 86400 * 41]
    rows = [("E1", "a", T0 + timedelta(seconds=s), str(i)) for i, s in enumerate(steps)]
    assert run(spark, rows) == walk(rows)


@pytest.mark.parametrize("seed", range(4))
def test_random_rows_with_ties_and_copies(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(400):
        iface = rnd.choice(["E1", "E1", "E1", "E2", None])
        seconds = rnd.choice([0, 0, rnd.randrange(7200), rnd.randrange(86400 * 9)])
        rows.append((iface, rnd.choice(["a", "b", None]), T0 + timedelta(seconds=seconds), str(rnd.randrange(150))))
    rows += rows[:60] + rows[:20]
    assert run(spark, rows, partitions=1 + seed * 3) == walk(rows)


def test_hot_instant_and_hot_copies(spark):
    rows = [("E1", "a", T0, "7")] * 300 + [("E1", "a", T0 - 2 * DAY, "1")] + [("E1", "a", T0, str(i)) for i in range(100, 400)]
    got = run(spark, rows)
    assert got == walk(rows)
    assert sum(n for r, n in got.items() if r[5]) == 599


def test_nothing_is_written_and_the_scan_is_read_once(spark):
    rows = [("E1", "a", T0, "1"), ("E1", "a", T0, "1"), ("E1", "a", T0 + DAY, "2"), (None, None, None, "3")]
    out = add_recurrence(spark.createDataFrame(rows, SCHEMA))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and "Join" not in plan
    assert sorted((r.number, r.recurs_24h) for r in out.collect()) == [("1", False), ("1", True), ("2", True), ("3", False)]


@pytest.mark.parametrize("seed", range(3))
def test_pair_totals_equal_the_rows(spark, seed):
    rnd = random.Random(seed)
    rows = [
        (rnd.choice(["E1", "E2", None]), rnd.choice(["a", "b"]), T0 + timedelta(minutes=rnd.randrange(20000)), str(i))
        for i in range(300)
    ]
    expected = Counter()
    for r, n in walk(rows).items():
        if r[0] is not None:
            expected[(r[0], r[1])] += n * r[5]
    got = recurrence_pairs(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r[0], r[1]): r[2] for r in got} == dict(expected)
    assert [r[2] for r in got] == sorted((r[2] for r in got), reverse=True)


def test_no_window_orders_the_raw_rows(spark):
    df = spark.createDataFrame([("E1", "a", T0, "1")], SCHEMA)
    plan = recurrence_pairs(df)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Window") :]
    assert "partial_min" in below and "partial_max" in below
    with pytest.raises(ValueError):
        recurrence_pairs(df, hours=0)


def test_rows_are_kept_whole(spark):
    df = spark.range(50).select(
        F.lit("E1").alias("primary_interface"), F.lit("a").alias("error_family"),
        F.lit(T0).cast("timestamp_ntz").alias("opened_dt"), F.col("id").cast("string").alias("number"),
    )
    out = add_recurrence(df)
    assert out.columns == [*df.columns, "prev_time", "recurs_24h"]
    assert out.where("recurs_24h").count() == 49
