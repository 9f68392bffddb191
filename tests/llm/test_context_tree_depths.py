"""The byte tree of ``context_tree`` against its definition: every depth, across words, to the end of the text."""

import collections
import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from faultline.llm import context_tree
from faultline.llm.shingles import hashed_words
from llm import brute

DEPTH = context_tree.DEPTH


class ByteTree(brute.ContextTree):
    """Contexts of the last 0 to ``DEPTH`` bytes of the text, 255 before its start; the text ends with 255."""

    @staticmethod
    def decisions(text):
        symbols = [*text, 255]
        for i, s in enumerate(symbols):
            before = ([255] * DEPTH + symbols[:i])[-DEPTH:]
            for k in range(8):
                yield [(tuple(before[DEPTH - d :]), (1 << k) | (s >> (8 - k))) for d in range(DEPTH + 1)], (s >> (7 - k)) & 1


def plain(text):
    return (text or "").translate(brute.LOWER).encode().replace(b"\x00", b"\xfe")


@pytest.mark.parametrize("block, piece", [(300_000, 2 << 20), (1, 7)])
def test_scores_from_the_definition(spark, monkeypatch, block, piece):
    monkeypatch.setattr(context_tree, "BLOCK_ROWS", block)
    monkeypatch.setattr(context_tree, "PIECE", piece)
    rows = [
        (1, "The cat sat on the mat.\nThe  cat"), (2, "the cat sat on a hat"), (3, None), (4, ""), (5, "naïve café\x00 the"),
        (6, "a cat sat on the zebra"), (7, "the cat sat on the mat.\nthe  cat"), (1, "ccccccccc"), (8, "sat the on cat"), (None, "x"),
    ]
    out = {6, 7, 8}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = context_tree.score_texts(docs, F.col("doc_id").isin(*out)).collect()
    tree = ByteTree(collections.Counter(plain(t) for i, t in rows if i not in out))
    want = sorted((str(i), tree.log10(plain(t))) for i, t in rows)
    assert [i for i, _ in want] == sorted(str(r.doc_id) for r in got)
    assert [s for _, s in sorted((str(r.doc_id), r.score) for r in got)] == pytest.approx([s for _, s in want], abs=1e-8)
    bits = {r.doc_id: r.bits_per_byte for r in got}
    assert bits[7] == pytest.approx(-tree.log10(plain(rows[6][1])) * math.log2(10) / (len(rows[6][1]) + 1))
    # The order of words counts, so contexts go on across blanks.
    assert bits[8] > bits[7]


def test_runs_do_not_depend_on_pieces(monkeypatch):
    texts = [b"", b"The cat", b"", b"a" * 50, b"x\x00y \n", b"z"]
    whole = [(k, o) for keys, owner in context_tree.run_pieces(texts) for k, o in zip(keys.tolist(), owner.tolist(), strict=True)]
    assert [o for _, o in whole] == [i for i, t in enumerate(texts) for _ in range(len(t) + 1)]
    monkeypatch.setattr(context_tree, "PIECE", 7)
    pieces = [(k, o) for keys, owner in context_tree.run_pieces(texts) for k, o in zip(keys.tolist(), owner.tolist(), strict=True)]
    assert pieces == whole


def test_keys_of_a_group_are_merged_as_they_come(monkeypatch):
    texts = ["The cat", None, "", "the cat sat\n" * 3, "naïve"]
    group = pa.concat_tables([pa.table({"text": texts[:2]}), pa.table({"text": texts[2:]})])
    raw = [(t or "").encode() for t in texts]
    want = {int(k) for keys, _ in context_tree.run_pieces(raw) for k in keys}
    want |= set(context_tree.word_keys(np.concatenate(list(hashed_words(raw)))).tolist())
    for pending in (1_000_000, 3):
        monkeypatch.setattr(context_tree, "PENDING", pending)
        assert context_tree.asked_keys(group).tolist() == sorted(want)


def test_memory_of_a_group_follows_its_distinct_keys_not_its_texts():
    """Four times the text with the same runs: neither the texts nor the runs of pieces may pile up."""
    rng = np.random.default_rng(3)
    text = " ".join(f"{k:x}" for k in rng.integers(0, 1 << 40, 25_000).tolist())
    peaks = []
    for copies in (24, 96):
        group = pa.table({"text": [text] * copies})
        tracemalloc.start()
        context_tree.asked_keys(group)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.5 * peaks[0]
