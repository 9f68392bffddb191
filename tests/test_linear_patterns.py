"""Hosts, wildcard files and lexicons: same matches as the plain patterns, in time linear in the text."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from faultline.functions import extract as X
from faultline.functions import families
from faultline.functions import patterns as P
from faultline.functions.text import all_matches

PIECES = [
    "app", "app123", "app1234", "a", "Z9", "-", "_", ".", "*", "**", " ", "\t", "\n", "/", "\\", ":", "é", "ñx", "example.net", ".example.net", ",", "(", "0",
]


def texts(spark, seed, n=4000):
    rng = random.Random(seed)
    rows = [(i, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14)))) for i in range(n)]
    return spark.createDataFrame(rows, "id long, t string")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_same_matches_as_the_plain_patterns(spark, seed):
    t = F.col("t")
    named = r"\b[A-Za-z0-9.-]+\.(?:example\.net)\b"
    hosts = F.concat(all_matches(t, P.APP_HOST, 0, True), all_matches(t, named, 0, True))
    pairs = {
        "hosts": (X.app_hosts(t, "example.net"), F.array_distinct(F.transform(hosts, lambda h: F.lower(h)))),
        "v3": (X.file_patterns(t, "v3"), F.array_distinct(all_matches(t, P.FILE_WILDCARD_V3, 0))),
        "v4": (X.file_patterns(t, "v4"), F.array_distinct(all_matches(t, P.FILE_WILDCARD_V4, 0))),
    }
    columns = [c.alias(f"{name}_{k}") for name, both in pairs.items() for k, c in enumerate(both)]
    found = texts(spark, seed).select("t", *columns)
    for name in pairs:
        wrong = found.where(f"{name}_0 <> {name}_1").select("t", f"{name}_0", f"{name}_1").take(3)
        assert not wrong, (name, wrong)
        assert found.where(F.size(f"{name}_0") > 0).count() > 100


@pytest.mark.parametrize("unit", ["a", "a-", "a.", "ab*", "*", "a*-", "app123-", "a_app", "x.example.net."])
def test_long_words_take_linear_time(spark, unit):
    text = unit * (1_000_000 // len(unit))
    df = spark.createDataFrame([(text,)], "t string").select(
        F.size(X.app_hosts(F.col("t"), "example.net")).alias("h"),
        F.size(X.file_patterns(F.col("t"), "v3")).alias("f"),
        F.size(X.file_patterns(F.col("t"), "v4")).alias("g"),
    )
    began = time.perf_counter()
    df.collect()
    assert time.perf_counter() - began < 6


def plain_family(text, lexicon):
    """Leftmost hit of the names' alternation, in plain Python."""
    sep = "[^A-Za-z0-9]*"
    names = [(n, re.findall("[A-Za-z0-9]+", n)) for n in lexicon]
    found = re.search("|".join(sep.join(w) for _, w in names if w), text, re.IGNORECASE | re.ASCII)
    if not found:
        return None
    key = re.sub("[^A-Za-z0-9]", "", found.group()).lower()
    return next(n for n, w in names if "".join(w).lower() == key)


@pytest.mark.parametrize("seed", range(4))
def test_prefix_tree_keeps_the_order_of_names(spark, seed):
    rng = random.Random(seed)
    lexicon = ["".join(rng.choice(["a", "b", "A", " ", "-"]) for _ in range(rng.randint(1, 6))) for _ in range(rng.choice([3, 9, 120]))]
    lexicon = [n for n in lexicon if re.search("[A-Za-z]", n)] or ["a"]
    rows = [("".join(rng.choice("abcAB -.") for _ in range(rng.randint(0, 10))),) for _ in range(600)]
    got = spark.createDataFrame(rows, "t string").select("t", families.flex_family(F.col("t"), lexicon, None).alias("f")).collect()
    assert [(r.t, r.f) for r in got] == [(r.t, plain_family(r.t, lexicon)) for r in got]


def test_twenty_thousand_names(spark, sf_dir):
    rng = random.Random(8)
    names = ["".join(rng.choice("etaoinshrd") for _ in range(rng.randint(5, 9))) for _ in range(20_000)]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    began = time.perf_counter()
    got = docs.select("text", families.flex_family(F.col("text"), names, None).alias("f")).collect()
    assert time.perf_counter() - began < 60
    keys = set(names)
    for r in got[:40]:
        low = re.sub("[^A-Za-z0-9]", "\n", (r.text or "")).lower()
        hits = [(i, n) for i in range(len(low)) for n in range(5, 10) if low[i : i + n] in keys and "\n" not in low[i : i + n]]
        first = min((i for i, _ in hits), default=None)
        here = [low[i : i + n] for i, n in hits if i == first]
        assert r.f == (min(here, key=names.index) if here else None)
    assert sum(r.f is not None for r in got) > 20
