"""Phrase collocations against a plain version and SQL, and their cases."""

import collections
import random
import re
import types

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from faultline.llm import collocations, oracles, queries
from llm.brute import LOWER

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, least, most=2000):
    """The same from the definition, in whole numbers."""
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    longer = collections.Counter()
    candidates = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    for (lang, words), a in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                longer[lang, words[i : i + k]] = max(longer[lang, words[i : i + k]], a)
    found = collections.defaultdict(list)
    for (lang, words), a in candidates.items():
        cuts = [(f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
        score, _, (l, r) = min((1000 * a * n[lang] // (l * r), k, (l, r)) for k, (l, r) in enumerate(cuts))
        if longer[lang, words] < a:
            found[lang].append((-score, -a, " ".join(words).encode(), l, r))
    result = []
    for lang, phrases in found.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(phrases)[:most], 1):
            result.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(result)


def got(spark, rows, **options):
    docs = spark.createDataFrame(rows, "lang string, text string").withColumns({"n": F.lit(1), "phrase": F.lit("x"), "w1": F.lit(2)})
    return sorted(tuple(r) for r in collocations.collocations(docs, **options).select(*COLUMNS).collect())


def sentences(rng, words, n):
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".\n", "\r"]) for _ in range(n))


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_version(spark, seed):
    rng = random.Random(seed)
    words = ["The", "the", "of", "é", "no-one", "x y", "a", "b", "中", "rare1", "rare2"]
    rows = [(rng.choice(["en", "de", None, "und"]), sentences(rng, words, rng.randint(0, 400))) for _ in range(60)]
    rows += [("en", "new york city hall now") for _ in range(9)] * 2 + [("en", None), (None, ""), ("fr", " \t\n")]
    for least, most in ((5, 2000), (18, 2000), (3, 40)):
        assert got(spark, rows, least=least, most=most) == plain(rows, least, most)


def test_saturated_marks_change_nothing(spark):
    rng = random.Random(9)
    rows = [("en", sentences(rng, ["a", "b", "c", "d", "e"], 300)) for _ in range(5)]
    assert got(spark, rows, least=4, bits=7) == plain(rows, 4)


def test_chunks_count_every_window_once(monkeypatch):
    rng = random.Random(4)
    monkeypatch.setattr(collocations, "PIECE", 64)
    for blanks in ([" "], [" ", "\n"], [" ", "  ", "\n", "\n\n"]):
        texts = ["".join(rng.choice(["a", "bb", "ccc", "d" * 90]) + rng.choice(blanks) for _ in range(rng.randint(0, 120))) for _ in range(30)]
        want, have = collections.Counter(), collections.Counter()
        for text in texts:
            for piece in text.split("\n"):
                words = piece.split()
                want.update(tuple(words[i : i + 5]) for i in range(len(words)))
        for chunk, limit in collocations.joined_chunks([t.encode() for t in texts]):
            _, starts, ends, near, count = collocations.scan(chunk, limit)
            for i in range(count):
                last = i
                while last - i < 4 and near[last]:
                    last += 1
                have[tuple(chunk[s:e].decode() for s, e in zip(starts[i : last + 1], ends[i : last + 1], strict=True))] += 1
        assert have == want


def test_hashes_tell_words_apart():
    words = [b"w%d" % i for i in range(20_000)] + [b"ab", b"ba", b"a", b"aa"]
    hashes, *_ = collocations.scan(b" ".join(words), 1 << 30)
    assert len(np.unique(hashes)) == len(words)


def test_very_long_piece_and_word(spark):
    rows = [("en", "to be or " * 150_000), ("en", "z" * 3_000_000 + " to be")]
    assert got(spark, rows, least=1000) == plain(rows, 1000)


def test_scores_beyond_64_bits(spark):
    counts = [("en", 0, [], "", 10**15), ("en", 1, ["a"], "a", 10**9), ("en", 1, ["b"], "b", 10**9), ("en", 2, ["a", "b"], "a b", 10**9 - 1)]
    over = 1000 * (10**9 - 1) * 10**15
    df = spark.createDataFrame(counts, "lang string, size int, words array<string>, phrase string, f long")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(collocations, "phrase_counts", lambda *a, **k: df)
        assert got(spark, [("en", "x")]) == [("en", 1, "a b", 10**9 - 1, 10**9, 10**9, 10**15, over // 10**18)]


def test_empty_table(spark):
    assert got(spark, []) == []


def test_query_equals_sql(spark, sf_dir):
    con = connect(sf_dir)
    assert difference(queries.op11_collocations(spark, sf_dir), con, oracles.oracle_sql()["op11_collocations"]) is None


def test_a_batch_passes_on_equal_windows_once(monkeypatch):
    monkeypatch.setattr(collocations, "PIECE", 500)
    rng = random.Random(12)
    words = ["The", "of", "é", "no-one", "a", "b", "中"]
    batch = [(rng.choice(["en", "de", "x"]), sentences(rng, words, 60)) for _ in range(80)]
    want = collections.Counter()
    for lang, text in batch:
        for piece in re.split(r"[.,;:!?\n-\r]", text.translate(LOWER)):
            found = piece.split()
            want.update((lang, *(found[i : i + 5] + [""] * 5)[:5]) for i in range(len(found)))
    table = pa.table(dict(zip(("lang", "text"), map(list, zip(*batch, strict=True)), strict=True)))
    step = collocations._windows(types.SimpleNamespace(value=[]))()
    rows = [tuple(r.values()) for b in step(table.to_batches()[0]) for r in b.to_pylist()]
    assert len(rows) == len(want)
    assert {tuple(window): n for *window, n in rows} == want


def test_a_task_passes_on_equal_words_once():
    table = pa.table({"lang": ["en", "en"], "text": ["a b c a", "b b"]})
    step = collocations._count_keys(types.SimpleNamespace(value=[]))()
    made = [b for _ in range(3) for b in step(table.to_batches()[0])] + list(step.end())
    assert sorted(n for b in made for n in b.column("n").to_pylist()) == [3, 6, 9]


def test_windows_leave_a_task_as_phrase_sums_in_blocks():
    rng = random.Random(5)
    batch = [(rng.choice(["en", "de"]), sentences(rng, ["The", "of", "é", "no-one", "a", "b", "中"], 90)) for _ in range(60)]
    want = collections.Counter()
    for lang, text in batch * 3:
        for piece in re.split(r"[.,;:!?\n-\r]", text.translate(LOWER)):
            found = piece.split()
            want[lang, ""] += len(found)
            want.update((lang, " ".join(found[i : i + k])) for k in range(1, 6) for i in range(len(found) - k + 1))
    rows = pa.table(dict(zip(("lang", "text"), map(list, zip(*batch, strict=True)), strict=True))).to_batches()[0]
    step = collocations._phrase_blocks(types.SimpleNamespace(value=[]))()
    made = [b for _ in range(3) for b in step(rows)] + list(step.end())
    assert len(want) > 2 * collocations.PARTS >= 2 * sum(b.num_rows for b in made)
    sums = [collocations._often_phrases(1)(pa.Table.from_batches([b.slice(i, 1)])) for b in made for i in range(b.num_rows)]
    assert {(lang, phrase): f for t in sums for lang, phrase, f in zip(*t.to_pydict().values(), strict=True)} == want


@pytest.mark.parametrize("held", [1, 10, 3_000_000])
def test_key_blocks_mark_what_all_tasks_find_often(monkeypatch, held):
    monkeypatch.setattr(collocations, "HELD_KEYS", held)
    rng = random.Random(6)
    words = [f"w{k}" for k in range(3000)]
    texts = [" ".join(rng.choices(words, range(1, 3001), k=4000)) for _ in range(6)]
    often = {w for w, n in collections.Counter(w for t in texts for w in t.split()).items() if n >= 8}
    made = []
    for text in texts:
        step = collocations._key_blocks(types.SimpleNamespace(value=[]), 8)()
        made += [*step(pa.table({"lang": ["en"], "text": [text]}).to_batches()[0]), *step.end()]
    assert all(b.num_rows <= collocations.PARTS for b in made)
    blocks = pa.Table.from_batches(made)
    table = np.zeros(1 << 18, np.uint64)
    for part in set(blocks["part"].to_pylist()):
        marks = collocations._often(8, 24)(blocks.filter(collocations.pc.equal(blocks["part"], part)))
        np.bitwise_or.at(table, marks["at"].to_numpy(), marks["m"].to_numpy().view(np.uint64))
    (_, salt, chunk, limit), *_ = collocations._by_language(pa.table({"lang": ["en"], "text": [" ".join(words)]}).to_batches()[0])
    keys = collocations.run_keys(collocations.mix(collocations.scan(chunk, limit)[0] ^ salt), 1)
    known = dict(zip(words, collocations.marked(table, keys).tolist(), strict=True))
    assert all(known[w] for w in often)
    assert sum(known.values()) <= len(often) + 5 < len(words) - 100


def test_numbers_survive_packing():
    for numbers in ([], [0], [1, 255, 256, (1 << 32) - 1] * 70):
        assert collocations.unpacked(collocations.packed(np.array(numbers, np.int64))).tolist() == numbers


def test_windows_are_passed_on_when_many(spark, monkeypatch):
    rng = random.Random(7)
    rows = [("en", sentences(rng, ["a", "b", "c", "d", "e"], 300)) for _ in range(8)]
    want = plain(rows, 4)
    for name, value in (("HELD_WINDOWS", 3), ("HELD_BYTES", 100)):
        monkeypatch.setattr(collocations, name, value)
        step = collocations._phrase_blocks(types.SimpleNamespace(value=[]))()
        batch = pa.table(dict(zip(("lang", "text"), map(list, zip(*rows, strict=True)), strict=True))).to_batches()[0]
        made = list(step(batch))
        assert len(made) == 1 and not list(step.end())
        monkeypatch.undo()
    assert got(spark, rows, least=4) == want
