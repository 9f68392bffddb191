"""Exact join of documents whose word-shingle sets have a Jaccard similarity of at least 0.8.

1. Every text becomes a set of shingle hashes. Equal sets share one node (a hash of
   the set); a task passes on the details of a set only once, so copies collapse
   before any shuffle.
2. Two linked sets share a shingle among the first ``n - ceil(0.8 n) + 1`` of either,
   in any common order. The order puts shingles found in many documents last, so the
   rest of the order, by hash, meets mostly rare ones. (The list of common shingles
   steers the work only; the result does not depend on it.)
   In the smaller of the two it is even among the first ``n - ceil(8 n / 9) + 1``, and
   their sizes are at most 4 to 5, so shingles shared only by chance mostly drop out.
3. Nodes sharing such a shingle, of about the same size, form a tile: key is shingle
   and size band, and a node near a band's end also visits the next. Shingles that the
   very same nodes have make one tile, so two long near copies meet once or a few times
   and not at every shingle. Large tiles are cut into pairs of blocks, by rows and by
   shingles. Inside a tile hashed bitmaps of at least four bits a shingle bound each
   overlap from above: a bit of one side that the other lacks is a shingle it lacks.
4. Pairs that pass are verified by intersecting the sorted arrays. A tile offers all pairs
   of nodes with at most ``OFFERS`` passing partners, of the rest a spanning forest of those
   whose bitmaps are closest; links found make components. Tiles that left pairs out are
   gone through once more: the bitmaps tell which nodes have passing partners in other
   components, each pair in the tile of its first common shingle only. The sets of these
   nodes then come to the tile, and pairs are
   verified on the spot unless their two sides are joined already. A tile gives at most
   a spanning set of links, so no link that matters is missed, while a large group of
   copies or of almost-copies never becomes its pairs.

Defined cases: NULL text, or text without a word, has an empty set, linked with
nothing. Fewer words than a shingle make one shingle. Rows sharing an id are separate
documents; a NULL id is never a component's name if another id is in it. Two sets
share a 64-bit node hash, or two shingles a hash, with negligible chance (about
n^2 / 2^65 over n distinct ones), two tiles' node lists their 128 bits even less. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import arrow_stage, as_bytes, stored
from faultline.llm.components import components
from faultline.llm.shingles import shingle_sets

COMMON_LEAST = 4
COMMON_MOST = 1 << 20
BAND_RATIO = 0.8**4
BLOCK = 1024
BLOCK_SHINGLES = 4 << 20
OFFERS = 4
TILE_ROWS = 20_000
TILE_BYTES = 32 << 20
PAIRS = 1 << 19
FLUSH = 1 << 21
NEEDED_BITS = 23


def least_overlap(a, b):
    """Smallest overlap with which sets of sizes ``a`` and ``b`` have 100 * shared >= 80 * union."""
    return -(-4 * (a + b) // 9)


def prefix_length(n: int) -> int:
    return n - -(-4 * n // 5) + 1


def short_prefix(n):
    """Shingles of the prefix among which the first one shared with a set that is as large or larger is found."""
    return n - F.ceil(8 * n / 9) + 1


def bitmap_bits(n: int) -> int:
    """Bits of a set's bitmap: the power of two from four times its size."""
    return max(64, 1 << (4 * n - 1).bit_length())


def bitmap(found: np.ndarray) -> bytes:
    bits = np.zeros(bitmap_bits(len(found)), np.uint8)
    bits[found & np.uint64(len(bits) - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def folded(raw: bytes, size: int) -> np.ndarray:
    """A bitmap at ``size`` bytes: halves of a power-of-two bitmap are ORed."""
    found = np.frombuffer(raw, np.uint64)
    return found if len(raw) == size else np.bitwise_or.reduce(found.reshape(-1, size // 8), axis=0)


def common_shingles(rows: DataFrame, size: int) -> np.ndarray:
    """Shingles that many documents have, from a count over all documents; at most ``COMMON_MOST``.

    A task counts ``FLUSH`` shingles at a time and passes on those met twice, so a
    shingle counts here when its documents meet. The list only orders the work.
    """

    def make():
        held: list[np.ndarray] = []

        def flush():
            if held:
                found, n = np.unique(np.concatenate(held), return_counts=True)
                held.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[n > 1].view(np.int64)), pa.array(n[n > 1].astype(np.int64))], ["shingle", "n"]
                )

        def step(batch: pa.RecordBatch):
            for found in shingle_sets(as_bytes(batch.column("text")), size):
                held.append(found)
                step.size += len(held[-1])
                if step.size >= FLUSH:
                    step.size = 0
                    yield from flush()

        step.size, step.end = 0, flush
        return step

    counts = arrow_stage(rows.select("text"), make, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= COMMON_LEAST).orderBy(F.desc("n")).limit(COMMON_MOST).toPandas()
    return np.sort(top["shingle"].to_numpy(np.int64).view(np.uint64))


def signed_sets(rows: DataFrame, common: np.ndarray, size: int) -> DataFrame:
    """``id``, ``node`` (NULL for an empty set), ``n``; once per task and node also ``bits`` and ``prefix``."""
    shared = rows.sparkSession.sparkContext.broadcast(common)

    def make():
        seen, common = set(), shared.value

        def details(found: np.ndarray) -> list[int]:
            at = np.minimum(np.searchsorted(common, found), max(len(common) - 1, 0))
            is_common = common[at] == found if len(common) else np.zeros(len(found), bool)
            ordered = np.concatenate([found[~is_common], found[is_common]])
            return ordered[: prefix_length(len(found))].view(np.int64)

        def step(batch: pa.RecordBatch):
            nodes, sizes, bits, prefixes = [], [], [], []
            for found in shingle_sets(as_bytes(batch.column("text")), size):
                node = None
                if len(found):
                    node = int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)
                new = node is not None and node not in seen
                if new:
                    if len(seen) >= 1 << 18:
                        seen.clear()
                    seen.add(node)
                nodes.append(node)
                sizes.append(len(found))
                bits.append(bitmap(found) if new else None)
                prefixes.append(details(found) if new else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(bits, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))],
                ["id", "node", "n", "bits", "prefix"],
            )

        return step

    kind = rows.schema["id"].dataType.simpleString()
    return arrow_stage(rows, make, f"id {kind}, node long, n long, bits binary, prefix array<long>")


def band(n: Column) -> Column:
    return F.floor(F.log(n) / -math.log(BAND_RATIO)).cast("int")


def shared_tokens(signed: DataFrame) -> DataFrame:
    """``token``, ``node`` and ``n`` of the prefix shingles that a node has in common with one it may be linked with.

    Linked sets have sizes of at most 4 to 5, and their first common shingle is in the short
    prefix of the smaller. In order of size the nearest such neighbour tells whether there is any.
    """
    offers = signed.where("prefix is not null").select(F.posexplode("prefix").alias("at", "token"), "node", "n")
    # Size and mark travel as one number, and the window's inputs are made after the shuffle.
    size = F.col("n") * 2 + (F.col("at") < short_prefix(F.col("n"))).cast("long")
    offers = offers.select("token", "node", size.alias("size")).repartition("token")
    offers = offers.select("token", "node", F.shiftright("size", 1).alias("n"), (F.col("size") % 2 == 1).alias("short"))
    order = Window.partitionBy("token").orderBy("n", "node")
    row = F.struct("n", "node")
    smaller = F.last(F.when(F.col("short"), row), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    met = offers.withColumns({"smaller": smaller, "larger": F.lead(row).over(order)})
    below = "smaller.node <> node and 4 * n <= 5 * smaller.n"
    above = "short and larger.node <> node and 4 * larger.n <= 5 * n"
    return met.where(f"({below}) or ({above})").select("token", "node", "n").distinct()


def unlike_tokens(repeated: DataFrame) -> DataFrame:
    """``repeated`` with one token, the smallest, of those that have the same nodes; nodes that meet still meet."""
    hashes = [F.xxhash64("node"), F.xxhash64("node", F.lit(1))]
    lists = repeated.groupBy("token").agg(F.count("*").alias("nodes"), *[F.bit_xor(h).alias(f"h{k}") for k, h in enumerate(hashes)])
    chosen = lists.groupBy("nodes", "h0", "h1").agg(F.min("token").alias("token")).select("token")
    return repeated.join(chosen, "token", "left_semi")


def tiles(repeated: DataFrame, signed: DataFrame) -> DataFrame:
    """Rows ``token``, ``band``, ``k``, ``l`` (blocks), ``block``, ``node``, ``n``, ``bits`` of all tiles."""
    size = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    large = repeated.groupBy("token").agg(size.alias("blocks")).where("blocks > 1")
    details = signed.where("bits is not null").groupBy("node").agg(F.first("bits").alias("bits"))
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda other: F.struct(F.least(own, other).alias("k"), F.greatest(own, other).alias("l")),
    )
    bands = F.array_distinct(F.array(band(F.col("n")), band(F.col("n") * 5 / 4 + 1)))
    return (
        repeated.join(large, "token", "left")
        .withColumns({"block": own, "cell": F.explode(cells)})
        .select("token", "node", "block", "cell.k", "cell.l", "n")
        .join(details, "node")
        .withColumn("band", F.explode(bands))
        .drop("cell")
    )


def bounds(sizes: np.ndarray, bits: list[bytes], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Upper bound of the overlap of the pairs ``left``, ``right`` (row numbers), from their bitmaps."""
    a, b = sizes[left], sizes[right]
    widths = np.array([len(x) for x in bits])
    narrow = np.minimum(widths[left], widths[right])
    most = np.zeros(len(left), np.int64)
    for width in np.unique(narrow):
        at = np.flatnonzero(narrow == width)
        rows, where = np.unique(np.concatenate([left[at], right[at]]), return_inverse=True)
        table = np.stack([folded(bits[i], int(width)) for i in rows])
        x_at, y_at = where[: len(at)], where[len(at) :]
        step = max(1, (1 << 19) // table.shape[1])
        for start in range(0, len(at), step):
            p = slice(start, start + step)
            x, y = table[x_at[p]], table[y_at[p]]
            lacks_x = np.bitwise_count(y & ~x).sum(axis=1).astype(np.int64)
            lacks_y = np.bitwise_count(x & ~y).sum(axis=1).astype(np.int64)
            q = at[p]
            most[q] = np.minimum(a[q] - lacks_y, b[q] - lacks_x)
    return most


def met_before(key: np.ndarray, token: np.ndarray, earlier: list[list[int]]) -> dict[int, np.ndarray]:
    """Per tile (by its first row) which of its rows share an earlier token, so that they meet in that tile already."""
    out = {}
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    for lo, hi in zip(starts, np.r_[starts[1:], len(key)], strict=True):
        if hi - lo > 1:
            lengths = [len(x) for x in earlier[lo:hi]]
            every = np.fromiter((t for x in earlier[lo:hi] for t in x), np.int64, sum(lengths))
            owner = np.repeat(np.arange(hi - lo), lengths)
            before = every < token[lo]
            found, at, n = np.unique(every[before], return_inverse=True, return_counts=True)
            twice = n[at] > 1
            table = np.zeros((hi - lo, len(found)), np.float32)
            table[owner[before][twice], at[twice]] = 1
            table = table[:, n > 1]
            out[int(lo)] = table @ table.T > 0
    return out


def size_pairs(key: np.ndarray, cols: dict[str, np.ndarray], met: dict[int, np.ndarray] | None = None):
    """Row pairs of the tiles that fit by size, label and block and have not ``met``, about ``PAIRS`` at a time."""
    tile = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], np.arange(len(key)), 0))
    same_block = cols["k"] == cols["l"]
    left, right, held = [], [], 0
    rows, apart = np.arange(len(key)), 1
    while len(rows := rows[rows + apart < len(key)]):
        rows = rows[key[rows] == key[rows + apart]]
        for start in range(0, len(rows), PAIRS):
            i, j = rows[start : start + PAIRS], rows[start : start + PAIRS] + apart
            a, b = cols["n"][i], cols["n"][j]
            fits = np.minimum(a, b) >= least_overlap(a, b)
            fits &= (cols["label"][i] != cols["label"][j]) & (same_block[i] | (cols["block"][i] != cols["block"][j]))
            i, j = i[fits], j[fits]
            if met is not None and len(i):
                fresh = np.array([not met[s][x - s, y - s] for s, x, y in zip(tile[i].tolist(), i.tolist(), j.tolist(), strict=True)])
                i, j = i[fresh], j[fresh]
            left.append(i)
            right.append(j)
            held += len(i)
            if held >= PAIRS:
                yield np.concatenate(left), np.concatenate(right)
                left, right, held = [], [], 0
        apart += 1
    if held:
        yield np.concatenate(left), np.concatenate(right)


def spanning(a: np.ndarray, b: np.ndarray, share: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Pairs, by number, of largest share first, that join what ``root`` keeps apart; ``root`` then has them joined."""

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    chosen, order = [], np.argsort(-share, kind="stable")
    for start in range(0, len(order), 4096):
        while (root[root] != root).any():
            root[:] = root[root]
        some = order[start : start + 4096]
        for i in some[root[a[some]] != root[b[some]]].tolist():
            x, y = find(a[i]), find(b[i])
            if x != y:
                root[max(x, y)] = min(x, y)
                chosen.append(i)
    return np.array(chosen, np.int64)


def tile_offers(cols: dict[str, np.ndarray], key: np.ndarray, bits: list[bytes], most: int):
    """Passing node pairs of whole tiles, and the tokens of the tiles where some were left out.

    Pairs of a node with at most ``most`` partners so far are all given, of the others a spanning
    forest, so a group of any size gives no more than ``most`` pairs a node, a large one about one.
    """
    nodes, local = np.unique(cols["node"], return_inverse=True)
    known = np.zeros(0, np.int64)
    partners, root = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
    for left, right in size_pairs(key, cols):
        a, b = np.minimum(local[left], local[right]), np.maximum(local[left], local[right])
        code, first = np.unique(a * len(nodes) + b, return_index=True)
        fresh = first[~np.isin(code, known)]
        known = np.union1d(known, code)
        if not len(fresh):
            continue
        left, right = left[fresh], right[fresh]
        least = least_overlap(cols["n"][left], cols["n"][right])
        bound = bounds(cols["n"], bits, left, right)
        ok = bound >= least
        a, b, share = a[fresh][ok], b[fresh][ok], bound[ok] / least[ok]
        partners += np.bincount(a, minlength=len(nodes)) + np.bincount(b, minlength=len(nodes))
        chosen = (partners[a] <= most) | (partners[b] <= most)
        few, many = np.flatnonzero(chosen), np.flatnonzero(~chosen)
        spanning(a[few], b[few], share[few], root)
        chosen[many[spanning(a[many], b[many], share[many], root)]] = True
        yield nodes[a[chosen]], nodes[b[chosen]], np.unique(cols["token"][left[ok][~chosen]])


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Exact number of common values of two sorted arrays without repeats."""
    if len(x) > len(y):
        x, y = y, x
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return int((y[at] == x).sum())


def tile_links(cols: dict[str, np.ndarray], key: np.ndarray, sets: list[bytes]):
    """Verified node pairs of whole tiles that join different components: at most a spanning set of them."""
    _, own = np.unique(cols["label"], return_inverse=True)
    root = np.arange(own.max() + 1)
    arrays = [np.frombuffer(x, np.uint64) for x in sets]
    bits = [bitmap(x) for x in arrays]

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for left, right in size_pairs(key, cols):
        while (root[root] != root).any():
            root[:] = root[root]
        apart = root[own[left]] != root[own[right]]
        left, right = left[apart], right[apart]
        least = least_overlap(cols["n"][left], cols["n"][right])
        bound = bounds(cols["n"], bits, left, right)
        ok = np.flatnonzero(bound >= least)
        ok = ok[np.argsort(-(bound[ok] / least[ok]), kind="stable")]
        a, b = [], []
        for i, j, need in zip(left[ok].tolist(), right[ok].tolist(), least[ok].tolist(), strict=True):
            x, y = find(own[i]), find(own[j])
            if x != y and overlap(arrays[i], arrays[j]) >= need:
                root[max(x, y)] = min(x, y)
                a.append(i)
                b.append(j)
        yield cols["node"][a], cols["node"][b]


CELL = "token long, band int, k int, l int, block int, node long, n long, label long"


def whole_tiles(rows: DataFrame, solve, schema: str = "a long, b long") -> DataFrame:
    """What ``solve(cols, key, lists)`` yields for complete tiles, a bounded number of rows and bytes at a time."""
    key = ["token", "band", "k", "l"]
    wide = ("bits", "own", "shingles")
    rows = rows.select(*key, "block", "node", "n", "label", *[c for c in wide if c in rows.columns])
    rows = rows.repartition(*key).sortWithinPartitions(*key)
    names = [x.split()[0] for x in schema.split(", ")]

    def make():
        held: list[pa.RecordBatch] = []

        def close(last: bool):
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            cols = {n: table.column(n).to_numpy() for n in table.column_names if n not in wide}
            new = np.r_[True, np.logical_or.reduce([cols[k][1:] != cols[k][:-1] for k in key])]
            cut = len(new) if last else int(np.flatnonzero(new)[-1])
            if cut < len(new):
                held.extend(table.slice(cut).to_batches())
            step.rows, step.bytes = len(new) - cut, sum(b.nbytes for b in held)
            if not cut:
                return
            lists = {n: table.column(n).slice(0, cut).to_pylist() for n in wide if n in table.column_names}
            for found in solve({n: v[:cut] for n, v in cols.items()}, np.cumsum(new[:cut]), lists):
                yield pa.RecordBatch.from_arrays(list(found), names)

        def step(batch: pa.RecordBatch):
            held.append(batch)
            step.rows += batch.num_rows
            step.bytes += batch.nbytes
            if step.rows >= TILE_ROWS or step.bytes >= TILE_BYTES:
                yield from close(False)

        step.rows = step.bytes = 0
        step.end = lambda: close(True) if held else ()
        return step

    return arrow_stage(rows, make, schema)


def candidates(tile_rows: DataFrame, most: int) -> DataFrame:
    """Distinct pairs ``a``, ``b`` that pass in some tile; a row with NULL ``a`` says that the tiles of token ``b`` have more."""

    def solve(cols, key, lists):
        for a, b, more in tile_offers(cols, key, lists["bits"], most):
            yield pa.concat_arrays([pa.array(a), pa.nulls(len(more), pa.int64())]), pa.array(np.concatenate([b, more]))

    return whole_tiles(tile_rows.withColumn("label", F.col("node")), solve).distinct()


def open_cells(again: DataFrame, signed: DataFrame, labels: DataFrame) -> DataFrame:
    """Tile rows (``CELL``) of the nodes that have, in that tile, a passing partner in another component."""
    # The tokens by which a node may meet others: a pair then counts in the tile of its first common one only.
    own = again.groupBy("node").agg(F.array_sort(F.collect_set("token")).alias("own"))
    rows = tiles(again, signed).join(labels, "node", "left").withColumn("label", F.coalesce("component", "node")).join(own, "node")

    def solve(cols, key, lists):
        needed = np.zeros(len(key), bool)
        for left, right in size_pairs(key, cols, met_before(key, cols["token"], lists["own"])):
            fresh = ~(needed[left] & needed[right])
            left, right = left[fresh], right[fresh]
            ok = bounds(cols["n"], lists["bits"], left, right) >= least_overlap(cols["n"][left], cols["n"][right])
            needed[left[ok]] = needed[right[ok]] = True
        yield [pa.array(cols[x.split()[0]][needed]) for x in CELL.split(", ")]

    return whole_tiles(rows, solve, CELL)


def missing_links(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified links inside the tiles of ``cells``, enough to join all labels that belong together."""

    def solve(cols, key, lists):
        for a, b in tile_links(cols, key, lists["shingles"]):
            yield pa.array(a), pa.array(b)

    return whole_tiles(cells.join(sets, "node"), solve).distinct()


def sets_of(rows: DataFrame, signed: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """``node`` and ``shingles`` (binary) of the distinct ``nodes``, hashed again from one text each.

    The scan skips texts by a bit table of fixed size over the ids needed; a join then
    keeps the nodes needed.
    """
    slot = F.pmod(F.xxhash64("id"), F.lit(1 << NEEDED_BITS))
    owners = signed.select("node", slot.alias("slot")).join(nodes, "node").groupBy("node").agg(F.min("slot").alias("slot"))
    masks = owners.groupBy(F.shiftright("slot", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int))) as m"))
    found = masks.toPandas()
    table = np.zeros(1 << (NEEDED_BITS - 6), np.uint64)
    table[found["w"].to_numpy(np.int64)] = found["m"].to_numpy(np.int64).view(np.uint64)
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def make():
        table, seen = shared.value, set()

        def step(batch: pa.RecordBatch):
            slots = batch.column("slot").to_numpy().astype(np.uint64)
            needed = (table[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1)
            out, sets = [], []
            for found in shingle_sets(as_bytes(batch.column("text").filter(pa.array(needed == 1))), size):
                if not len(found):
                    continue
                raw = found.tobytes()
                node = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)
                if node in seen:
                    continue
                if len(seen) >= 1 << 18:
                    seen.clear()
                seen.add(node)
                out.append(node)
                sets.append(raw)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), pa.array(sets, pa.binary())], ["node", "shingles"])

        return step

    made = arrow_stage(rows.select("text", slot.alias("slot")), make, "node long, shingles binary")
    return made.join(nodes, "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose exact overlap reaches the similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")

    def make():
        def step(batch: pa.RecordBatch):
            rows = batch.to_pydict()
            keep = []
            for x, y in zip(rows["x"], rows["y"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                keep.append(overlap(x, y) >= least_overlap(len(x), len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return step

    return arrow_stage(joined, make, "a long, b long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5) -> DataFrame:
    """One row per document: its id, ``n_shingles`` and ``component_id``, the smallest id reachable by links."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    signed = stored(signed_sets(rows, common_shingles(rows, size), size), "sets")
    shared = stored(unlike_tokens(stored(shared_tokens(signed), "tokens")), "tokens")
    offers = stored(candidates(tiles(shared, signed), OFFERS), "pairs")
    pairs = offers.where("a is not null")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    links = stored(verified(pairs, sets_of(rows, signed, nodes, size)), "links")
    found = stored(components(links), "components")
    unfinished = offers.where("a is null").select(F.col("b").alias("token"))
    if unfinished.limit(1).count():
        again = stored(shared.join(unfinished, "token", "left_semi"), "tokens")
        cells = stored(open_cells(again, signed, found), "cells")
        more = stored(missing_links(cells, sets_of(rows, signed, cells.select("node").distinct(), size)), "links")
        found = stored(components(links.unionByName(more)), "components")
    members = signed.select("id", "node", "n").join(found, "node", "left")
    named = members.withColumn("class", F.coalesce("component", "node"))
    smallest = named.where("class is not null").groupBy("class").agg(F.min("id").alias("least"))
    return named.join(smallest, "class", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"),
    )
