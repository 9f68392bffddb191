"""Benchmark passages inside documents: SimHash of item-sized windows, then exact similarity.

The benchmark is taken in blocks of bounded size, each against all documents. For
every item length the windows of that many shingles are looked at, but only those
holding enough shingles of some item: fewer cannot reach the similarity. Their
64-bit SimHash (shingles weighted by how often they stand in the window) is looked
up in multi-index blocks: of eight bytes at least one differs in at most
``RADIUS // 8`` bits when all differ in at most ``RADIUS``, so nothing within the
radius is missed. Candidates are verified by the weighted Jaccard similarity of the
shingle counts. A repeated shingle turns many bits at once, so a fingerprint says little
where window or item repeats one: such windows are compared with every item of that
length that shares a shingle with them, through the items' shingle lists.

Defined cases: NULL or empty items match nothing; NULL or empty documents hold
nothing. An item shorter than a shingle matches only a document of exactly its words;
a document shorter than an item is one window. Of equal windows the first is
reported. Repeated items and documents are reported each. Only ids and texts are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import arrow_stage, as_bytes
from faultline.llm.shingles import hashed_words, shingle_hashes

RADIUS = 23
BLOCK_CHARS = 8 << 20


@dataclass(frozen=True)
class ItemBlock:
    """Items of one block, grouped by their number of shingles."""

    ids: list
    shingles: list[np.ndarray]
    n_words: list[int]
    every: np.ndarray
    by_size: dict[int, np.ndarray]
    near: dict[int, np.ndarray]
    prints: np.ndarray
    #: Of each size the items that repeat a shingle.
    repeating: dict[int, np.ndarray]
    #: Entries (shingle's place in ``every``, size's rank in ``by_size``) as one ascending number, with item and count.
    keys: np.ndarray
    holders: np.ndarray
    counts: np.ndarray


def signs(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of a hash's 64 bits."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def fingerprint(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=-1, bitorder="little").view(np.uint64)[..., 0]


def item_block(rows: list[tuple], size: int) -> ItemBlock:
    found = list(hashed_words([(text or "").encode() for _, text in rows]))
    kept = [i for i, w in enumerate(found) if len(w)]
    shingles = [shingle_hashes(found[i], size) for i in kept]
    prints = np.array([fingerprint(signs(s).sum(axis=0)) for s in shingles], np.uint64)
    sizes = np.array([len(s) for s in shingles], np.int64)
    by_size = {int(m): np.flatnonzero(sizes == m) for m in np.unique(sizes)}
    # near[m][b, v]: which items of size m have, in byte b, a value within RADIUS // 8 bits of v.
    close = np.bitwise_count(np.arange(256)[:, None] ^ np.arange(256)[None, :]) <= RADIUS // 8
    near = {m: close[:, prints[at].view(np.uint8).reshape(-1, 8).T].transpose(1, 0, 2) for m, at in by_size.items()}
    every = np.unique(np.concatenate(shingles)) if shingles else np.zeros(0, np.uint64)
    parts = [np.unique(x, return_counts=True) for x in shingles]
    repeats = np.array([c.max() > 1 for _, c in parts], bool)
    repeating = {m: at[repeats[at]] for m, at in by_size.items() if repeats[at].any()}
    lengths = [len(v) for v, _ in parts]
    holders = np.repeat(np.arange(len(parts)), lengths)
    rank = np.repeat(np.searchsorted(np.array(list(by_size), np.int64), sizes), lengths)
    values = np.concatenate([v for v, _ in parts]) if parts else every
    counts = np.concatenate([c for _, c in parts]) if parts else np.zeros(0, np.int64)
    keys = np.searchsorted(every, values) * len(by_size) + rank
    order = np.argsort(keys, kind="stable")
    return ItemBlock(
        [rows[i][0] for i in kept], shingles, [len(found[i]) for i in kept], every, by_size, near, prints,
        repeating, keys[order], holders[order], counts[order],
    )


def weighted_jaccard(x: np.ndarray, y: np.ndarray) -> float:
    values, inverse = np.unique(np.concatenate([x, y]), return_inverse=True)
    a = np.bincount(inverse[: len(x)], minlength=len(values))
    b = np.bincount(inverse[len(x) :], minlength=len(values))
    return float(np.minimum(a, b).sum() / np.maximum(a, b).sum())


def repeats_before(found: np.ndarray) -> np.ndarray:
    """For each shingle the place of the same one before it, -1 if there is none."""
    order = np.argsort(found, kind="stable")
    same = found[order[1:]] == found[order[:-1]]
    before = np.full(len(found), -1)
    before[order[1:][same]] = order[:-1][same]
    return before


def windows_repeating(before: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` shingles whether one stands in it more than once."""
    at = np.flatnonzero((before >= 0) & (np.arange(len(before)) - before < width))
    steps = np.zeros(len(before) + 1, np.int64)
    np.add.at(steps, np.maximum(at - width + 1, 0), 1)
    np.add.at(steps, before[at] + 1, -1)
    return np.cumsum(steps)[: len(before) - width + 1] > 0


def compared(places: np.ndarray, width: int, m: int, rank: int, block: ItemBlock) -> tuple[np.ndarray, np.ndarray]:
    """Items of ``m`` shingles that share one with a window, and their exact similarities; ``places`` are in ``every``."""
    values, times = np.unique(places, return_counts=True)
    wanted = values * len(block.by_size) + rank
    first, last = np.searchsorted(block.keys, wanted), np.searchsorted(block.keys, wanted, side="right")
    n = last - first
    at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
    items, inverse = np.unique(block.holders[at], return_inverse=True)
    shared = np.bincount(inverse, np.minimum(np.repeat(times, n), block.counts[at]), len(items))
    return items, shared / (width + m - shared)


def matches(found: np.ndarray, block: ItemBlock, similarity: float) -> dict[int, tuple[float, int, int, int]]:
    """Per item of the block that the document's shingles hold: similarity, start, shingles and bits apart."""
    best: dict[int, tuple[float, int, int, int]] = {}
    if not len(found) or not len(block.every):
        return best
    places = np.minimum(np.searchsorted(block.every, found), len(block.every) - 1)
    hit = block.every[places] == found
    if not hit.any():
        return best
    hits = np.concatenate([[0], np.cumsum(hit)])
    before = repeats_before(found)
    for rank, (m, items) in enumerate(block.by_size.items()):
        width = min(m, len(found))
        if width < similarity * m:
            continue
        inside = hits[width:] - hits[:-width]
        starts = np.flatnonzero(inside * (1 + similarity) >= similarity * (width + m) - 1e-9)
        if not len(starts):
            continue
        again, repeating = windows_repeating(before, width), block.repeating.get(m)
        for lo in range(0, len(starts), 4096):
            part = starts[lo : lo + 4096]
            first, last = part[0], part[-1] + width
            if last - first > 64 * (width + len(part)):  # far apart: one by one
                sums = np.stack([signs(found[s : s + width]).sum(axis=0) for s in part])
            else:
                total = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(signs(found[first:last]), axis=0)])
                sums = total[part - first + width] - total[part - first]
            prints = fingerprint(sums)
            parts = prints.view(np.uint8).reshape(-1, 8)
            near = block.near[m]
            for s, own, value in zip(part, parts, prints, strict=True):
                if again[s] or repeating is not None:
                    inside_window = places[s : s + width][hit[s : s + width]]
                    for i, score in zip(*compared(inside_window, width, m, rank, block), strict=True):
                        if score >= similarity - 1e-12 and (i not in best or score > best[i][0]):
                            best[int(i)] = (float(score), int(s), width, int(np.bitwise_count(block.prints[i] ^ value)))
                    continue
                maybe = items[near[np.arange(8), own].any(axis=0)]
                apart = np.bitwise_count(block.prints[maybe] ^ value)
                for i, bits in zip(maybe[apart <= RADIUS], apart[apart <= RADIUS], strict=True):
                    score = weighted_jaccard(found[s : s + width], block.shingles[i])
                    if score >= similarity - 1e-12 and (i not in best or score > best[i][0]):
                        best[int(i)] = (score, int(s), width, int(bits))
    return best


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = 5,
    similarity: float = 0.8,
) -> DataFrame:
    """One row per document and benchmark item it holds: ids, ``start_word``, ``n_words``, ``similarity``, ``bits_apart``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    items = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    kind, item_kind = rows.schema["id"].dataType.simpleString(), items.schema["item"].dataType.simpleString()
    schema = f"id {kind}, item {item_kind}, start_word long, n_words long, similarity double, bits_apart int"
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = int(chars // BLOCK_CHARS) + 1
    out = None
    for k in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect()
        shared = docs.sparkSession.sparkContext.broadcast(item_block([tuple(r) for r in mine], size).__dict__)
        part = arrow_stage(rows, _finder(shared, size, similarity, items.schema["item"].dataType), schema)
        out = part if out is None else out.unionByName(part)
    return out.withColumnsRenamed({"id": id_col, "item": item_col})


def _finder(shared, size: int, similarity: float, item_type):
    from pyspark.sql.pandas.types import to_arrow_type

    arrow_item = to_arrow_type(item_type)

    def make():
        block = ItemBlock(**shared.value)

        def step(batch: pa.RecordBatch):
            rows: list[tuple] = []
            at: list[int] = []
            for k, found in enumerate(hashed_words(as_bytes(batch.column("text")))):
                hashes = shingle_hashes(found, size)
                for i, (score, start, width, bits) in sorted(matches(hashes, block, similarity).items()):
                    rows.append((block.ids[i], start, min(width + size - 1, len(found)), score, bits))
                    at.append(k)
            cols = list(zip(*rows, strict=True)) or [()] * 5
            types = [arrow_item, pa.int64(), pa.int64(), pa.float64(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))],
                ["id", "item", "start_word", "n_words", "similarity", "bits_apart"],
            )

        return step

    return make
