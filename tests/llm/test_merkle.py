"""The Merkle manifest against a plain version, its layout, and its cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import merkle, queries
from faultline.llm.common import remainder
from llm.brute import merkle as plain

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
COLUMNS = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def built(spark, rows, height=merkle.HEIGHT):
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"pos": F.lit(1), "n": F.lit("x"), "leaf": F.lit(2)})
    return merkle.build(merkle.leaves(docs, remainder(F.col("doc_id"), 5) == 0), height)


def found(manifest):
    return sorted((tuple(r) for r in merkle.verify(manifest).select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("height", range(5))
def test_layout_places_every_node_once(height):
    places = np.concatenate(merkle.addresses(height))
    assert sorted(places.tolist()) == list(range(merkle.tree_size(height + 1)))
    assert merkle.addresses(height)[-1].tolist() == [0]


def test_layout_keeps_lower_subtrees_together():
    leaves = merkle.addresses(3)[0].reshape(-1, 16)  # four levels: the runs of the lowest two lie beside each other
    assert (np.diff(leaves, axis=1) == 1).all()
    assert (merkle.addresses(3)[1] == leaves[:, 0] - 1).all()


def test_cases(spark):
    rows = [
        (None, None, None, None, None), (None, "", "de", 3, "Äb"), (7, "b", "en", 1, "X"), (7, "b", "en", 1, "X"),
        (7, "b", "en", 1, "y"), (10**18, "b", None, 0, ""), (-5, "é", "en", 2, "A\0B"), (3, "b", "en", 9, "Z" * 100_000),
        *[(i, "many", "en", i, f"Text {i}") for i in range(300)],
    ]
    assert found(built(spark, rows)) == plain(rows)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 257, 4096, 4097, 4200])
def test_sizes_of_one_source(spark, n):
    rows = [(i, "one", "en", i % 7, f"Words {i}") for i in range(n)]
    assert found(built(spark, rows)) == plain(rows)


def test_many_sources(spark):
    rows = [(i, f"s{i % 300}", "en", i, f"T{i}") for i in range(900)]
    assert found(built(spark, rows)) == plain(rows)


@pytest.mark.parametrize("height", [1, 2])
def test_more_layers(spark, height):
    rows = [(i, "hot" if i % 3 else f"s{i % 40}", "en", i, f"T{i}") for i in range(700)]
    assert found(built(spark, rows, height)) == plain(rows)


def test_proofs_lead_to_the_root(spark):
    rows = [(i, f"s{i % 3}", "en", i, f"T{i}") for i in range(50)]
    manifest = built(spark, rows)
    root = {r.root for r in manifest.sources.collect()}
    assert len(root) == 1
    for r in merkle.proofs(manifest).collect():
        assert {merkle.fold(bytes(r.digest), bytes(r.path))} == {bytes(x) for x in root}


def test_empty_table(spark):
    manifest = built(spark, [])
    assert found(manifest) == [] and merkle.proofs(manifest).count() == 0 and manifest.sources.count() == 0


def test_query_equals_plain_version(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    got = queries.op13_merkle(spark, sf_dir).select("doc_id", *COLUMNS[1:])
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain([tuple(r) for r in docs.collect()])
