"""Language-model scores by context-tree weighting over the bytes of whole texts.

A text is its bytes with A-Z in lower case, blanks and line ends as they are, then one end
(byte 255, which UTF-8 never holds). Every byte is eight binary decisions. A decision's
contexts are the last 0, 1, 2, ... ``DEPTH`` bytes, across words and lines (255 before the
text begins): a tree with every depth, each node with a Krichevsky-Trofimov estimate from
the training counts. Context-tree weighting mixes all depths: a node's weight is half its
own estimate and half the product of its children's weights, at the last depth its
estimate; the posterior of these halves gives the mixture for every decision. What is left
for a context never trained on stays with the longest one that was.

The statistics are one table of all distinct runs of ``DEPTH + 1`` bytes with their training
counts: runs of a context's shorter ends are sums of it. It is grouped by the two bytes
before the last one, so one task holds the subtree of such a context, a bounded number of
rows at a time beyond the largest; the levels above have at most 65,536 contexts of 255
decisions and go through the driver. Texts meet the scores of their runs in chunks of bounded
size: a chunk asks once for each distinct run, so neither positions nor a whole table are
shipped. The base counts words by 63-bit hashes (two of n distinct words share one with a
chance of about n^2 / 2^64) in the same table, as negative keys.

Defined cases: NULL text is empty and has one token, the end. A row whose training flag
is NULL is trained on. Repeated rows count and are scored each. With nothing to learn
from, all decisions are even. Byte 0 is read as 254, another byte outside UTF-8. Only id
and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import arrow_stage, as_bytes, release, ship_package, slices, stored, summed
from faultline.llm.krichevsky import kt_one, log_kt
from faultline.llm.shingles import LOWER, hashed_words
from faultline.llm.word_tree import stretches, upper_counts, word_scores  # noqa: F401  (tests of the word tree name them here)

DEPTH = 5
CHUNK_BYTES = 16 << 20
#: Symbols whose runs are made at a time, distinct runs held before a task passes them on, rows of the table solved at a time.
PIECE = 1 << 20
FLUSH_RUNS = 1_500_000
#: Keys of pieces that are gathered before they are merged.
PENDING = 1_000_000
BLOCK_ROWS = 300_000
END = 255
#: A-Z to lower case, byte 0 to 254.
PLAIN = b"\xfe" + LOWER[1:]
WORD = np.uint64(1 << 63)


class UpperTree:
    """Depths 0 to 2: mixture so far, weight left for the deepest level, and the estimate where it is missing."""

    def __init__(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        node, near, leaf = key & 255, (key >> 8) & 255, key >> 16 == 0
        own = log_kt(zeros, ones)
        weights = [None, None, np.where(leaf, own, np.logaddexp(own, below) - math.log(2))]
        stops = [None, None, np.where(leaf, 1.0, np.exp(np.minimum(own - math.log(2) - weights[2], 0)))]
        groups = [node, (near << 8) | node]
        counts = []
        for depth in (1, 0):
            size = 1 << (16 if depth else 8)
            at, deeper = groups[depth], (weights[2] if depth else self_weight)
            below_sum = np.bincount(at if depth else np.arange(1 << 16) & 255, deeper, size)
            z, o = (np.bincount(groups[depth], c, size).astype(np.int64) for c in (zeros, ones))
            mine = log_kt(z, o)
            total = np.logaddexp(mine, below_sum) - math.log(2)
            counts.append((z, o, np.exp(np.minimum(mine - math.log(2) - total, 0))))
            self_weight = np.where(z + o > 0, total, 0.0)
        (z1, o1, stop1), (z0, o0, stop0) = counts
        self.end0 = kt_one(z0, o0)
        mix0, left0 = stop0 * self.end0, 1 - stop0
        both = np.arange(1 << 16)
        low = both & 255
        kt1 = kt_one(z1, o1)
        seen1 = z1 + o1 > 0
        self.end1 = np.where(seen1, mix0[low] + left0[low] * kt1, self.end0[low])
        mix1, left1 = mix0[low] + left0[low] * stop1 * kt1, left0[low] * (1 - stop1)
        at1 = (near << 8) | node
        kt2 = kt_one(zeros, ones)
        self.key = key
        self.end2 = mix1[at1] + left1[at1] * kt2
        self.mix2 = mix1[at1] + left1[at1] * stops[2] * kt2
        self.left2 = left1[at1] * (1 - stops[2])

    def one(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, deep: bool) -> np.ndarray:
        """Probability of a one at upper nodes ``key``, with the counts of the deepest nodes below."""
        if not len(self.key):
            return np.full(len(key), 0.5)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        known = self.key[at] == key
        end = np.where(known, self.end2[at], self.end1[key & 0xFFFF])
        if not deep:
            return end
        seen = known & (zeros + ones > 0)
        return np.where(seen, self.mix2[at] + self.left2[at] * kt_one(zeros, ones), end)

    def start(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mixture so far, weight left for longer contexts, and the estimate if there are none, at nodes ``key``."""
        if not len(self.key):
            return np.full(len(key), 0.5), np.zeros(len(key)), np.full(len(key), 0.5)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        known = self.key[at] == key
        end = np.where(known, self.end2[at], self.end1[key & 0xFFFF])
        return np.where(known, self.mix2[at], end), np.where(known, self.left2[at], 0.0), end


def _runs_of(data: np.ndarray) -> np.ndarray:
    """Key of the run that ends at each byte from ``DEPTH`` on: the bytes before, nearest first, then the byte."""
    size = len(data) - DEPTH
    keys = data[DEPTH:].astype(np.int64)
    for back in range(1, DEPTH + 1):
        keys |= data[DEPTH - back :][:size].astype(np.int64) << (8 * (DEPTH + 1 - back))
    return keys


def run_pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of the runs of all symbols of the texts, in order, and each one's text; about ``PIECE`` at a time."""
    pad = bytes([END]) * DEPTH
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= PIECE):
            size += len(texts[end]) + DEPTH
            end += 1
        data = np.frombuffer(pad + pad.join(t.translate(PLAIN) for t in texts[at:end]) + pad[:1], np.uint8)
        lengths = np.array([len(t) + 1 for t in texts[at:end]])
        # Between the end of a text and the next one's first byte stand ``DEPTH - 1`` paddings, which are no symbols.
        owner = np.full(len(data) - DEPTH, -1, np.int64)
        owner[np.arange(lengths.sum()) + np.repeat(np.arange(end - at) * (DEPTH - 1), lengths)] = np.repeat(np.arange(at, end), lengths)
        for start in range(0, len(owner), 2 * PIECE):
            mine = owner[start : start + 2 * PIECE]
            real = mine >= 0
            yield _runs_of(data[start : start + len(mine) + DEPTH])[real], mine[real]
        at = end


def word_keys(hashes: np.ndarray) -> np.ndarray:
    return (hashes | WORD).view(np.int64)


def run_table(rows: DataFrame) -> DataFrame:
    """``key`` and ``n``, the count in the training rows, of all runs (keys from 0) and words (keys below 0) of all rows."""

    def make():
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def merge():
            found, n = summed(keys, counts)
            keys[:], counts[:] = [found], [n]
            step.pending, step.size = 0, len(found)

        def flush():
            if keys:
                merge()
                found, n = keys.pop(), counts.pop()
                step.size = 0
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["key", "n"])

        def add(found: np.ndarray, weight: int):
            found, n = np.unique(found, return_counts=True)
            keys.append(found)
            counts.append(n.astype(np.int64) * weight)
            step.pending += len(found)
            if step.pending >= max(PENDING, step.size):
                merge()

        def step(batch: pa.RecordBatch):
            texts, held = as_bytes(batch.column("text")), batch.column("held_out").to_pylist()
            for out in (False, True):
                some = [t for t, h in zip(texts, held, strict=True) if h == out]
                if some:
                    for found, _ in run_pieces(some):
                        add(found, int(not out))
                    add(word_keys(np.concatenate(list(hashed_words(some)))), int(not out))
            if step.size >= FLUSH_RUNS:
                yield from flush()

        step.size, step.pending, step.end = 0, 0, flush
        return step

    found = arrow_stage(rows.select("text", "held_out"), make, "key long, n long")
    return found.groupBy("key").agg(F.sum("n").alias("n"))


def texts_of(group: pa.Table) -> Iterator[list[bytes]]:
    """The texts of a group in order, a slice of bounded size at a time."""
    for batch in group.select(["text"]).to_batches():
        for part in slices(batch):
            yield as_bytes(part.column("text"))


def distinct(keys: np.ndarray) -> np.ndarray:
    """Distinct keys, ascending; by sorting, as ``np.unique`` goes through a much slower hash table."""
    keys = np.sort(keys)
    return keys[np.r_[True, keys[1:] != keys[:-1]][: len(keys)]]


def asked_keys(group: pa.Table) -> np.ndarray:
    """Distinct keys, ascending, of all runs and words of the group's texts; those of pieces are merged as they come."""
    held = [np.zeros(0, np.int64)]
    pending = 0
    for texts in texts_of(group):
        for keys in (word_keys(np.concatenate(list(hashed_words(texts)))), *(keys for keys, _ in run_pieces(texts))):
            held.append(distinct(keys))
            pending += len(held[-1])
            if pending >= max(PENDING, len(held[0])):
                held, pending = [distinct(np.concatenate(held))], 0
    return distinct(np.concatenate(held))


class Subtrees:
    """Depths 2 to ``DEPTH`` of the trees below complete two-byte contexts, from sorted runs and their counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        #: Deepest first: runs, counts, and the row here of each row of the level before.
        self.levels = [(keys, counts, None)]
        for _ in range(DEPTH - 2):
            keys, at = np.unique((keys >> 16 << 8) | (keys & 255), return_inverse=True)
            counts = np.bincount(at, counts, len(keys)).astype(np.int64)
            self.levels.append((keys, counts, at))

    def decisions(self, bit: int):
        """One bit at all depths, deepest first: the deepest node of each row, the nodes' keys at depth 2, and per depth
        parents (None at depth 2), zeros, ones, share of the node's own estimate in its weight; last the log weights below depth 2."""
        depths, below, nodes, first, rows = [], None, None, None, None
        for level, (keys, counts, at) in enumerate(self.levels):
            prefix = keys >> (8 - bit)
            new = np.r_[True, prefix[1:] != prefix[:-1]]
            node, starts = np.cumsum(new) - 1, np.flatnonzero(new)
            ones = np.add.reduceat(counts * (keys >> (7 - bit) & 1), starts)
            zeros = np.add.reduceat(counts, starts) - ones
            if level:
                parent = node[at[first]]
                depths[-1][0] = parent
                below = np.bincount(parent, weight, len(starts))
            else:
                nodes = node
            own = log_kt(zeros, ones)
            weight = np.logaddexp(own, below) - math.log(2) if level else own
            stop = np.exp(np.minimum(own - math.log(2) - weight, 0)) if level else np.ones(len(own))
            depths.append([None, zeros, ones, stop])
            first, rows = starts, keys
        top = rows[first]
        context = (top >> 8 & 255) << 8 | top >> 16
        return nodes, context << 8 | 1 << bit | (top & 255) >> (8 - bit), depths, below

    def upper(self) -> dict[str, np.ndarray]:
        """Counts of the nodes at depth 2 met in training, and the log weights of the nodes below them."""
        found = []
        for bit in range(8):
            _, key, depths, below = self.decisions(bit)
            _, zeros, ones, _ = depths[-1]
            seen = zeros + ones > 0
            found.append([c[seen] for c in (key, zeros.astype(float), ones.astype(float), below)])
        return dict(zip(("key", "zeros", "ones", "below"), map(np.concatenate, zip(*found, strict=True)), strict=True))

    def scores(self, tree: UpperTree) -> np.ndarray:
        """Log10 probability of the last byte of each run after those before it."""
        keys = self.levels[0][0]
        total = np.zeros(len(keys))
        for bit in range(8):
            node, key, depths, _ = self.decisions(bit)
            so_far, left, end = tree.start(key)
            for parent, zeros, ones, stop in depths[-2::-1]:
                so_far, left, end = so_far[parent], left[parent], end[parent]
                seen, estimate = zeros + ones > 0, kt_one(zeros, ones)
                end = np.where(seen, so_far + left * estimate, end)
                so_far = np.where(seen, so_far + left * stop * estimate, end)
                left = np.where(seen, left * (1 - stop), 0.0)
            p = end[node]
            total += np.log10(np.where(keys >> (7 - bit) & 1, p, 1 - p))
        return total


def _by_context(runs: DataFrame, solve, schema: str) -> DataFrame:
    """``solve(keys, counts)`` on all runs of complete two-byte contexts, about ``BLOCK_ROWS`` at a time."""
    shift = 8 * (DEPTH - 1)
    rows = runs.withColumn("lead", F.shiftright("key", shift)).repartition("lead").sortWithinPartitions("key")

    def make():
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def close(last: bool):
            keys, counts = (np.concatenate(c) for c in zip(*held, strict=True))
            cut = len(keys) if last else int(np.searchsorted(keys, keys[-1] >> shift << shift))
            held[:] = [(keys[cut:], counts[cut:])] if cut < len(keys) else []
            step.size, step.tried = len(keys) - cut, len(keys) - cut
            if cut:
                yield solve(keys[:cut], counts[:cut])

        def step(batch: pa.RecordBatch):
            held.append((batch.column("key").to_numpy(), batch.column("n").to_numpy()))
            step.size += batch.num_rows
            if step.size >= max(BLOCK_ROWS, 2 * step.tried):
                yield from close(False)

        step.size = step.tried = 0
        step.end = lambda: close(True) if held else ()
        return step

    return arrow_stage(rows.select("key", "n"), make, schema)


def scored_runs(runs: DataFrame) -> DataFrame:
    """``key`` and ``value``, the log10 probability of the last byte of each run of ``runs``."""

    def collect(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(Subtrees(keys, counts).upper())

    upper = _by_context(runs, collect, "key long, zeros double, ones double, below double").orderBy("key").toPandas()
    columns = [upper["key"].to_numpy(np.int64), *(upper[c].to_numpy(float).astype(np.int64) for c in ("zeros", "ones"))]
    shared = runs.sparkSession.sparkContext.broadcast((*columns, upper["below"].to_numpy(float)))
    trees: list[UpperTree] = []

    def score(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        if not trees:
            trees.append(UpperTree(*shared.value))
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(Subtrees(keys, counts).scores(trees[0]))], ["key", "value"])

    return _by_context(runs, score, "key long, value double")


def score_texts(docs: DataFrame, held_out: Column, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and ``bits_per_byte``.

    ``bits_per_byte`` is the code length of the text and its end, by the number of both.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out")
    )
    facts = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"), F.count_if(~F.col("held_out")).alias("texts")).first()
    table = stored(run_table(rows), "runs")
    known = table.where("key < 0 and n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = int(facts.texts)
    total, distinct = int(known.n) + ends, int(known.v) + bool(ends)
    counted = table.where("key < 0").select("key", F.col("n").cast("double").alias("value"))
    scores = stored(scored_runs(table.where("key >= 0")).unionByName(counted), "run-scores")

    chunks = int(facts.bytes) // CHUNK_BYTES + 1
    parts = rows.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks)))

    def asked(group: pa.Table) -> pa.Table:
        found = asked_keys(group)
        release()  # the worker stays while the answers are joined
        chunk = group.column("chunk")[0].as_py()
        return pa.table({"chunk": pa.array(np.full(len(found), chunk)), "key": pa.array(found)})

    requests = parts.groupBy("chunk").applyInArrow(asked, "chunk long, key long")
    answers = requests.join(scores, "key").select("chunk", "key", "value")

    size = math.log10(total + distinct + 1)
    end_base = math.log10(ends + 1) - size

    def judge_texts(group: pa.Table, replies: pa.Table) -> list[np.ndarray]:
        value = replies.column("value").to_numpy()
        place = pd.Index(replies.column("key").to_numpy())
        columns, scores, per_byte = [[], [], []], [], []
        for texts in texts_of(group):
            score = np.zeros(len(texts))
            for keys, owner in run_pieces(texts):
                sums = np.bincount(owner - owner[0], value[place.get_indexer(keys)])
                score[owner[0] : owner[0] + len(sums)] += sums
            for hashes in hashed_words(texts):
                n = value[place.get_indexer(word_keys(hashes))]
                for column, found in zip(columns, (len(n) + 1, int((n > 0).sum()) + bool(ends), float((np.log10(n + 1) - size).sum()) + end_base), strict=True):
                    column.append(found)
            scores.append(score)
            per_byte.append(score * -math.log2(10) / np.array([len(t) + 1 for t in texts]))
        return [*columns, np.concatenate(scores), np.concatenate(per_byte)]

    def judge(group: pa.Table, replies: pa.Table) -> pa.Table:
        columns = judge_texts(group, replies)
        release()
        names = ["id", "held_out", "n_tokens", "n_known", "base_score", "score", "bits_per_byte"]
        return pa.table([group.column("id"), group.column("held_out"), *map(pa.array, columns)], names)

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, bits_per_byte double"
    judged = parts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(judge, schema)
    train_tokens = F.lit(total).cast("long").alias("train_tokens")
    return judged.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", train_tokens, "base_score", "score", "bits_per_byte")
