"""Near duplicates, benchmark passages, top-k search and components."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from faultline.llm import components, decontaminate, ngram_join, oracles, queries, voronoi
from llm import brute


def sentence(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(n))


def joined(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"node": F.lit("x"), "n": F.lit(None).cast("int")})
    got = ngram_join.near_duplicates(docs).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str)


def wanted(rows):
    found = brute.near_duplicate_components(rows)
    return sorted(((i, n, i if not n else c) for (i, _), (n, c) in zip(rows, found, strict=True)), key=str)


def test_ngram_join_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, sf_dir, "documents").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in queries.op10_ngram_join(spark, sf_dir).collect()), key=str)
    assert got == wanted(rows)


def test_ngram_join_of_edited_copies(spark, monkeypatch):
    """A family larger than the offers of a node, chains of edits, shared passages, small and odd texts."""
    monkeypatch.setattr(ngram_join, "OFFERS", 2)
    rng = random.Random(4)
    base, passage = sentence(rng, 120).split(), sentence(rng, 14)
    rows = [(0, " ".join(base))]
    for k in range(1, 25):
        text = list(base)
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = sentence(rng, 1)
        rows.append((k, " ".join(text)))
    chain = list(base)
    for k in range(30, 38):  # each close to the one before only
        chain = chain[3:] + sentence(rng, 3).split()
        rows.append((k, " ".join(chain)))
    rows += [(k, f"{sentence(rng, 30)} {passage} {sentence(rng, 30)}") for k in range(50, 62)]
    rows += [(70, None), (71, ""), (72, " \n "), (73, "one two"), (74, "ONE  two"), (75, "one"), (76, passage), (77, passage), (None, passage)]
    rows += [(78, passage + " x"), (73, "one two"), (79, "w " * 3000), (80, "w w w w w w")]
    assert joined(spark, rows) == wanted(rows)


@pytest.mark.parametrize("n", [5, 9, 10, 18, 45])
def test_ngram_join_at_the_threshold(spark, n):
    """Overlaps just at and just under 80 percent."""
    words = [f"w{k}" for k in range(n + 4)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, *(f"x{k}" for k in range(n // 4))])), (3, " ".join([*words, *(f"y{k}" for k in range(n // 4 + 1))]))]
    assert joined(spark, rows) == wanted(rows)


def test_ngram_join_blocks_and_large_tiles(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rng = random.Random(8)
    base = sentence(rng, 40).split()
    rows = []
    for k in range(30):
        text = list(base)
        text[k] = f"edit{k}"
        rows.append((k, " ".join(text)))
    assert joined(spark, rows) == wanted(rows)


def test_a_large_group_of_near_copies_offers_about_one_pair_a_node():
    """Every tile holds all nodes, all of them alike: offers must follow the nodes, not nodes times partners."""
    nodes, tokens = 200, 10
    found = np.sort(np.random.default_rng(2).integers(0, 2**63, 50, dtype=np.int64).astype(np.uint64))
    token = np.repeat(np.arange(tokens), nodes)
    node = np.tile(np.arange(nodes), tokens)
    same = np.zeros(nodes * tokens, np.int64)
    cols = {"token": token, "node": node, "label": node, "n": same + 50, "k": same, "l": same, "block": same}
    pairs, more = set(), set()
    for a, b, left_out in ngram_join.tile_offers(cols, token, [ngram_join.bitmap(found)] * len(node), 4):
        pairs |= set(zip(a.tolist(), b.tolist(), strict=True))
        more |= set(left_out.tolist())
    assert nodes - 1 <= len(pairs) < 2 * nodes
    assert more  # the tiles that have the other pairs


def test_shingles_shared_by_sets_of_other_sizes_make_no_tiles(spark):
    rows = [(1, 100, [7, 8, 9]), (2, 126, [7]), (3, 125, [8]), (4, 100, [9]), (4, 100, [9]), (5, 100, [10]), (5, 100, [10])]
    signed = spark.createDataFrame(rows, "node long, n long, prefix array<long>")
    got = sorted(tuple(r) for r in ngram_join.shared_tokens(signed).collect())
    assert got == [(8, 1, 100), (8, 3, 125), (9, 1, 100), (9, 4, 100)]


def test_ngram_join_of_all_sizes_around_a_text(spark, monkeypatch):
    """Prefixes of one text: each is linked with those up to a quarter longer."""
    monkeypatch.setattr(ngram_join, "OFFERS", 1)
    words = sentence(random.Random(11), 300).split()
    rows = [(k, " ".join(words[:n])) for k, n in enumerate([5, 6, 7, 8, 9, 20, 24, 25, 28, 31, 60, 74, 80, 95, 150, 182, 190, 228, 300])]
    assert joined(spark, rows) == wanted(rows)


def test_ngram_join_of_nothing(spark):
    assert joined(spark, []) == []


def test_bitmap_bound_is_never_too_low():
    rng = np.random.default_rng(1)
    for n, m, both in ((3, 3, 3), (50, 60, 50), (400, 420, 390), (1000, 900, 100)):
        pool = rng.integers(0, 2**63, n + m - both, dtype=np.int64).astype(np.uint64)
        x, y = np.sort(pool[:n]), np.sort(pool[n - both :])
        bits = [ngram_join.bitmap(x), ngram_join.bitmap(y)]
        assert ngram_join.bounds(np.array([n, m]), bits, np.array([0]), np.array([1]))[0] >= both


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(8, 30)] + [(1, 1), (2, 3), (3, 2)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {k: 100 for k in range(100, 141)} | {k: 7 for k in range(7, 30)} | {2: 2, 3: 2}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_decontaminate_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, sf_dir, "documents").collect()]
    items = [(r.item_id, r.text) for r in queries.table(spark, sf_dir, "benchmark").collect()]
    got = {(r.doc_id, r.item_id): r.similarity for r in queries.op4_decontaminate(spark, sf_dir).collect()}
    want = brute.leaks(docs, items)
    assert got.keys() == want.keys() and want
    assert all(got[k] == pytest.approx(v) for k, v in want.items())


def leaks(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1))
    items = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    return sorted((r.doc_id is None, r.doc_id, r.item_id, r.start_word, r.n_words) for r in decontaminate.decontaminate(docs, items).collect())


def test_decontaminate_cases(spark, monkeypatch):
    rng = random.Random(6)
    item, short, edited = sentence(rng, 30), "just three words", sentence(rng, 60).split()
    changed = list(edited)
    changed[5] = "other"
    docs = [
        (1, f"{sentence(rng, 20)} {item} {sentence(rng, 9)} {item}"), (2, None), (3, ""), (4, sentence(rng, 500)),
        (5, short.upper()), (6, f"not {short} here"), (7, item.rsplit(" ", 2)[0]), (8, " ".join(changed)), (None, item), (1, item),
        (9, "w " * 20_000),
    ]
    items = [(1, item), (2, short), (3, None), (4, ""), (5, " ".join(edited)), (1, item), (6, "w " * 40)]
    want = [(False, 1, 1, 0, 30)] * 2 + [(False, 1, 1, 20, 30)] * 2 + [(False, 5, 2, 0, 3)] + [(False, 7, 1, 0, 28)] * 2
    want += [(False, 8, 5, 0, 60), (False, 9, 6, 0, 40)] + [(True, None, 1, 0, 30)] * 2
    assert leaks(spark, docs, items) == want
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 100)  # many blocks of items give the same
    assert leaks(spark, docs, items) == want
    assert leaks(spark, [], items) == leaks(spark, docs, []) == []


def test_decontaminate_finds_items_that_differ_in_one_repeated_shingle(spark):
    """Runs of one word in place of runs of another: the fingerprints lie far apart, the similarity is 0.8 or more."""
    rng = random.Random(12)
    docs, items = [], []
    for n, (plain, run) in enumerate([(50, 5), (86, 10), (182, 22)] * 4):
        words = sentence(rng, plain).split()
        items.append((n, " ".join(words + [f"fill{n}"] * run)))
        docs.append((2 * n, " ".join(words + [f"blank{n}"] * run)))
        docs.append((2 * n + 1, f"{sentence(rng, 30)} {items[-1][1]} {sentence(rng, 30)}"))
    got = {(d, i) for _, d, i, _, _ in leaks(spark, docs, items)}
    want = brute.leaks(docs, items).keys()
    assert got == want == {(2 * n + k, n) for n in range(12) for k in (0, 1)}


def test_windows_that_repeat_a_shingle():
    rng = np.random.default_rng(4)
    for size, kinds in ((1, 3), (40, 8), (60, 200)):
        found = rng.integers(0, kinds, size).astype(np.uint64)
        before = decontaminate.repeats_before(found)
        for width in {1, min(7, size), size}:
            want = [len(np.unique(found[s : s + width])) < width for s in range(size - width + 1)]
            assert decontaminate.windows_repeating(before, width).tolist() == want


def test_multi_index_finds_all_within_the_radius():
    rng = random.Random(9)
    block = decontaminate.item_block([(k, sentence(rng, 20)) for k in range(40)], 5)
    items = block.by_size[16]
    for target in range(40):
        flips = rng.sample(range(64), decontaminate.RADIUS)
        value = int(block.prints[target]) ^ sum(1 << f for f in flips)
        own = np.array([value], np.uint64).view(np.uint8)
        assert target in items[block.near[16][np.arange(8), own].any(axis=0)]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_top_k_query(spark, sf_dir, sf):
    folder = sf_dir.replace("sf0.001", f"sf{sf}")
    assert difference(queries.op9_top_k(spark, folder), connect(folder), oracles.oracle_sql()["op9_top_k"]) is None


def found(spark, rows, k=3, **options):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"rank": F.lit(1), "vec": F.lit("x")})
    got = voronoi.top_k(vectors, F.col("vec_id") % 10 == 0, k, **options).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)


def exact(rows, k=3):
    whole = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows]
    out = []
    for q, v in whole:
        if q % 10 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in whole if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_top_k_cases(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.normal(size=4)]) for k in range(60)]
    rows += [(100 + k, [1.0, 1.0, 1.0, 1.0]) for k in range(50)] + [(200, [0.5]), (201, [])]  # ties, shorter vectors
    bad = [(300, None), (310, [float("nan")] * 4), (320, [float("inf"), 0.0, 0.0, 0.0]), (330, [None, 1.0, 1.0, 1.0]), (340, [1e30, 0.0, 0.0, 0.0])]
    assert found(spark, rows + bad + [(None, [1.0] * 4)]) == exact(rows)
    monkeypatch.setattr(voronoi, "CELL_DATA", 7)
    monkeypatch.setattr(voronoi, "CELL_QUERIES", 2)
    assert found(spark, rows) == exact(rows)


def test_top_k_of_little(spark):
    assert found(spark, []) == [] and found(spark, [(1, [1.0])]) == [] and found(spark, [(10, [1.0])]) == []
    assert found(spark, [(10, [1.0, 0.0]), (3, [0.5, 0.5])]) == [(10, 1, 3, 256 * 128)]
    # Rows that share the query's id are never candidates, however many; their results are one query's.
    repeated = found(spark, [(10, [1.0])] * 8 + [(k, [0.25]) for k in range(1, 5)], k=2)
    assert {(i, score) for _, _, i, score in repeated} <= {(k, 256 * 64) for k in range(1, 5)} and len(repeated) == 2
