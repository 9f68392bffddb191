"""Context trees of single words: four depths (nothing, one byte, two bytes, the whole word so far).

The scores of ``context_tree`` no longer come from here; its query mixes every depth.
"""

from __future__ import annotations

import numpy as np

from faultline.llm.common import mix
from faultline.llm.krichevsky import log_kt
from faultline.llm.shingles import shingle_hashes

STRETCH = 16


def stretches(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each stretch of a text (as word hashes) begins, and its key; the last one holds the text's end."""
    pairs = shingle_hashes(hashes, 2) if len(hashes) > 1 else hashes[:0]
    starts = np.r_[0, np.flatnonzero(pairs % np.uint64(STRETCH) == 0) + 2]
    placed = np.r_[hashes, np.uint64(1)]
    places = np.arange(len(placed)) - np.repeat(starts, np.diff(np.r_[starts, len(placed)]))
    return starts, mix(np.add.reduceat(mix(placed + places.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), starts))


def decisions(group: list[bytes], counts: np.ndarray):
    """For each place in the (sorted) words and each bit: rows, context key, bit, and the deepest node's counts.

    Yields ``rows, key, bit, node, zeros, ones, deep``: per row its upper node
    (two bytes before and bits so far), its bit, its deepest node and that node's
    counts. ``deep`` is false at the first two places, where two bytes are all there is.
    """
    lengths = np.array([len(w) for w in group])
    order = np.zeros((len(group), 2), np.int64)  # the two bytes before
    flat = np.frombuffer(b"\x00".join(group) + b"\x00", np.uint8)
    starts = np.cumsum(lengths + 1) - lengths - 1
    same = np.r_[False, np.ones(len(group) - 1, bool)]  # shares the prefix with the row before
    rows = np.arange(len(group))
    place = 0
    while len(rows):
        symbol = flat[starts[rows] + place].astype(np.int64)
        context = (order[rows, 0] << 8) | order[rows, 1]
        run = same.copy()
        for bit in range(8):
            first = np.flatnonzero(~run)
            node = np.cumsum(~run) - 1
            n = counts[rows]
            one = (symbol >> (7 - bit)) & 1
            ones = np.add.reduceat(n * one, first)
            zeros = np.add.reduceat(n, first) - ones
            key = (context << 8) | (1 << bit) | (symbol >> (8 - bit))
            yield rows, key, one, node, zeros, ones, place >= 2
            run &= np.r_[False, one[1:] == one[:-1]]
        order[rows, 0] = order[rows, 1]
        order[rows, 1] = symbol
        alive = symbol != 0
        # Neighbours that go on together share the longer prefix.
        same = (run & alive)[alive]
        rows = rows[alive]
        if len(same):
            same[0] = False
        place += 1


def upper_counts(group: list[bytes], counts: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of the upper nodes met in the group, and the log weights of the deepest nodes below them."""
    keys, zero, one_, weight = [], [], [], []
    for rows, key, _, node, zeros, ones, deep in decisions(group, counts):
        first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        seen = zeros + ones > 0
        keys.append(key[first][seen])
        zero.append(zeros[seen])
        one_.append(ones[seen])
        weight.append(log_kt(zeros[seen], ones[seen]) if deep else np.zeros(int(seen.sum())))
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = {n: np.bincount(at, np.concatenate(v), len(found)).astype(float) for n, v in (("zeros", zero), ("ones", one_), ("below", weight))}
    return {"key": found} | sums


def word_scores(group: list[bytes], counts: np.ndarray, tree) -> np.ndarray:
    """Log10 probability of each word of the group, its end included."""
    total = np.zeros(len(group))
    for rows, key, bit, node, zeros, ones, deep in decisions(group, counts):
        first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        p = tree.one(key[first], zeros, ones, deep)[node]
        total[rows] += np.log10(np.where(bit == 1, p, 1 - p))
    return total
