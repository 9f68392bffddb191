"""Merkle manifest of a dataset, kept as blocks in van Emde Boas layout.

Every row is a leaf; per source the leaves ascend by id and every ``ARITY`` consecutive
nodes become their parent, until one node, the subroot, remains. Subroots, ordered by
source, make the tree of the whole dataset in the same way.

A tree is stored as aligned blocks of ``ARITY ** HEIGHT`` leaves. Inside a block the nodes
stand in van Emde Boas order: the upper half of the levels first, then each subtree of the
lower half, both halves laid out the same way. Where a node stands follows from its level
and number alone (``addresses``), for writing and for reading siblings, whatever the size
of a memory page. The roots of the blocks are the leaves of the next layer of blocks, so a
tree of n leaves has log(n) / log(ARITY ** HEIGHT) layers, and no task sees more than a block.

Building goes up: range-partitioned ranks, blocks, blocks of their roots. Proofs go down: a
block passes each of its leaves the siblings on the way to the root, as bytes (``path``).
Only digests travel, never texts.

Defined cases: a NULL field is hashed as ``-``. NULL ids come first, equal ids in the order
of their leaves, so repeated rows are leaves of their own. NULL is a source of its own and
the first. A lone leaf is its own subroot, a lone subroot the root; the proof is then empty.
An empty table has no blocks and no root. Columns other than the named fields are not read,
so their names cannot clash.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from faultline.llm.common import arrow_stage, stored
from faultline.llm.line_dedup import UPPER

ARITY = 16
HEIGHT = 3
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Proofs go out in batches of this many rows; one may take some kilobytes.
PROOF_ROWS = 256


@dataclass(frozen=True)
class Manifest:
    """``layers[k]``: blocks of layer k of all sources; ``sources``: subroot, root and path of each; a full block's height."""

    layers: list[DataFrame]
    sources: DataFrame
    height: int


# --- layout -----------------------------------------------------------------------------


def tree_size(levels: int) -> int:
    """Nodes of a complete tree of that many levels."""
    return (ARITY**levels - 1) // (ARITY - 1)


def place(depth: int, number: np.ndarray, levels: int) -> np.ndarray:
    """Where the nodes ``number`` of a depth (0: root) stand in the layout of a tree of ``levels`` levels."""
    if levels == 1:
        return np.zeros_like(number)
    top = levels // 2
    if depth < top:
        return place(depth, number, top)
    below = ARITY ** (depth - top)
    inside = place(depth - top, number % below, levels - top)
    return tree_size(top) + number // below * tree_size(levels - top) + inside


@functools.cache
def addresses(height: int) -> list[np.ndarray]:
    """Per level, leaves first, the places of its nodes in a block of that height."""
    return [place(height - up, np.arange(ARITY ** (height - up)), height + 1) for up in range(height + 1)]


def height_of(n: int, most: int) -> int:
    """Levels above ``n`` leaves until one node remains, ``most`` of them at most."""
    height = 0
    while height < most and ARITY**height < n:
        height += 1
    return height


def build_block(leaves: list[bytes], height: int) -> bytes:
    """The nodes over ``leaves`` in the layout; places without a node are zero."""
    nodes = np.zeros((tree_size(height + 1), DIGEST), np.uint8)
    level = leaves
    for up, at in enumerate(addresses(height)):
        nodes[at[: len(level)]] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, DIGEST)
        if up < height:
            text = b"".join(level).hex()
            run = 2 * DIGEST * ARITY
            level = [hashlib.sha256(text[i : i + run].encode()).digest() for i in range(0, len(text), run)]
    return nodes.tobytes()


def local_paths(nodes: bytes, n: int, height: int) -> list[bytes]:
    """Per leaf its siblings up to the block's root: place in its run, number of others, the others, level by level."""
    table = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)
    found = [b""] * n
    for up, at in enumerate(addresses(height)[:height]):
        count = -(-n // ARITY**up)
        level = table[at[:count]].tobytes()
        steps = []
        for k in range(count):
            first = k - k % ARITY
            last = min(first + ARITY, count)
            others = level[first * DIGEST : k * DIGEST] + level[(k + 1) * DIGEST : last * DIGEST]
            steps.append(bytes([k - first, last - first - 1]) + others)
        found = [path + steps[k // ARITY**up] for k, path in enumerate(found)]
    return found


def steps_of(path: bytes) -> Iterator[tuple[int, str]]:
    """``(place in the run, the others as hex text)`` of each level of a path."""
    at = 0
    while at < len(path):
        end = at + 2 + path[at + 1] * DIGEST
        yield path[at], path[at + 2 : end].hex()
        at = end


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that follows from a leaf and the siblings on its way."""
    for where, others in steps_of(path):
        cut = where * 2 * DIGEST
        leaf = hashlib.sha256((others[:cut] + leaf.hex() + others[cut:]).encode()).digest()
    return leaf


def proof_digest(path: bytes) -> str:
    """Digest of the siblings of a path, left to right, level by level."""
    return hashlib.sha256("".join(others for _, others in steps_of(path)).encode()).hexdigest()


# --- leaves and ranks ---------------------------------------------------------------------


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 over the fields, each ``-`` if NULL, else its UTF-8 byte count, ``:`` and its value."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def leaves(
    docs: DataFrame, tampered: Column | None = None, *, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """``id``, ``source``, ``leaf`` and ``other``: the leaf of the row as tampered with, NULL if it was left alone.

    ``tampered`` marks rows whose text has lost its capital letters A-Z.
    """
    own = leaf_digest([F.col(f) for f in fields])
    lowered = F.translate(text_col, UPPER, UPPER.lower())
    other = leaf_digest([lowered if f == text_col else F.col(f) for f in fields])
    marked = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    return docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        own.alias("leaf"),
        F.when(marked, other).alias("other"),
    )


def ranked(nodes: DataFrame, tree: list[str], order: list[Column], name: str) -> DataFrame:
    """Stored rows with ``pos``, their place from 0 in the order inside their tree, and ``n``, the tree's rows.

    A range partitioning sorts; the counts per tree and partition give each partition its first place.
    """
    sortable = nodes.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(sortable.withColumn("_at", F.monotonically_increasing_id()), name)
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    counts = rows.groupBy(*tree, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(*tree) if tree else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *[F.col(t).alias(f"_{t}") for t in tree],
        F.col("_part").alias("_p"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("n"),
    )
    same = F.col("_part") == F.col("_p")
    for t in tree:
        same = same & F.col(t).eqNullSafe(F.col(f"_{t}"))
    joined = rows.join(starts, same).withColumn("pos", F.col("_at") + F.col("_shift"))
    return joined.select(*nodes.columns, "pos", "n")


# --- blocks, upwards ----------------------------------------------------------------------


def _block_rows(rows: DataFrame, payload: list[str], most: int) -> DataFrame:
    """One row per block of ``source, pos, n, digest`` rows; payload columns become lists in leaf order."""
    schema = T.StructType().add("source", "string").add("block", "long").add("n", "long").add("size", "integer").add("nodes", "binary").add("root", "binary")
    for name in payload:
        schema = schema.add(name, T.ArrayType(rows.schema[name].dataType))
    kinds = [to_arrow_type(schema[name].dataType) for name in payload]

    def make():
        held: dict = {"key": None, "rows": []}

        def close():
            if held["key"] is None:
                return
            source, block, n = held["key"]
            digests = [r[0] for r in held["rows"]]
            height = height_of(n, most)
            nodes = build_block(digests, height)
            columns = [
                pa.array([source], pa.string()), pa.array([block], pa.int64()), pa.array([n], pa.int64()),
                pa.array([len(digests)], pa.int32()), pa.array([nodes], pa.binary()),
                pa.array([nodes[:DIGEST]], pa.binary()),
            ]
            columns += [pa.array([[r[1 + k] for r in held["rows"]]], kind) for k, kind in enumerate(kinds)]
            held["key"], held["rows"] = None, []
            yield pa.RecordBatch.from_arrays(columns, schema.names)

        def step(batch: pa.RecordBatch):
            columns = [batch.column(c).to_pylist() for c in ("source", "block", "n", "digest", *payload)]
            for source, block, n, *values in zip(*columns, strict=True):
                if (source, block, n) != held["key"]:
                    yield from close()
                    held["key"] = (source, block, n)
                held["rows"].append(values)

        step.end = close
        return step

    dealt = rows.withColumn("block", F.expr(f"pos div {ARITY**most}")).repartition("source", "block")
    return arrow_stage(dealt.sortWithinPartitions("source", "block", "pos"), make, schema)


def _layers(rows: DataFrame, payload: list[str], height: int, name: str) -> list[DataFrame]:
    """Stored layers of blocks over ``source, pos, n, digest`` rows, leaves first."""
    block = ARITY**height
    found = [stored(_block_rows(rows, payload, height), f"{name}-0")]
    most = found[0].agg(F.max("n")).first()[0] or 0
    while most > block:
        most = -(-most // block)
        above = found[-1].where(F.col("n") > block)
        count = F.expr(f"(n + {block - 1}) div {block}").alias("n")
        above = above.select("source", F.col("block").alias("pos"), count, F.col("root").alias("digest"))
        found.append(stored(_block_rows(above, [], height), f"{name}-{len(found)}"))
    return found


def build(leaf_rows: DataFrame, height: int = HEIGHT) -> Manifest:
    """The manifest of ``leaves(...)`` rows in blocks of ``ARITY ** height`` leaves."""
    rows = stored(leaf_rows, "merkle-leaves")
    order = [F.col("source").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("leaf").asc()]
    placed = ranked(rows, ["source"], order, "merkle-ranked")
    layers = _layers(placed.withColumnRenamed("leaf", "digest"), ["id", "other"], height, "merkle-blocks")
    tops = [layer.where(F.col("n") <= ARITY**height).select("source", F.col("root").alias("digest")) for layer in layers]
    subroots = functools.reduce(DataFrame.unionByName, tops)
    numbered = ranked(subroots, [], [F.col("source").asc_nulls_first()], "merkle-subroots")
    upper = _layers(numbered.select(F.lit(None).cast("string").alias("source"), "pos", "n", "digest", F.col("source").alias("name")), ["name"], height, "merkle-sources")
    top = upper[-1].select("root").first()
    root = F.lit(None if top is None else bytes(top[0])).cast("binary").alias("root")
    members = _members(_descend(upper, None, height), ["name"], height)
    sources = members.select(F.col("name").alias("source"), F.col("digest").alias("subroot"), root, "path")
    return Manifest(layers, stored(sources, "merkle-roots"), height)


# --- proofs, downwards ----------------------------------------------------------------------


def _above(layer: DataFrame, given: DataFrame) -> DataFrame:
    """Blocks of a layer with the path from their root, joined by source and block."""
    given = given.select(F.col("source").alias("_source"), F.col("block").alias("_block"), F.col("path").alias("above"))
    return layer.join(given, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))).drop("_source", "_block")


def _descend(layers: list[DataFrame], tops: DataFrame | None, height: int) -> DataFrame:
    """The first layer's blocks with ``above``: the path from the block's root to the last root.

    ``tops`` has the path of each source's subroot; without it the trees' own tops are the last roots.
    """
    given = None
    for k in range(len(layers) - 1, -1, -1):
        single = layers[k].where(F.col("n") <= ARITY**height).select("source", "block")
        if tops is None:
            paths = single.withColumn("path", F.lit(b""))
        else:
            named = tops.select(F.col("source").alias("_source"), "path")
            paths = single.join(named, F.col("source").eqNullSafe(F.col("_source"))).select("source", "block", "path")
        if given is not None:
            paths = paths.unionByName(_children(given, height))
        given = _above(layers[k], paths)
    return given


def _children(blocks: DataFrame, height: int) -> DataFrame:
    """``source, block, path`` of the blocks below: each leaf of these is the root of one of those."""
    members = _members(blocks, [], height)
    return members.select("source", F.col("pos").alias("block"), "path")


def _members(blocks: DataFrame, payload: list[str], height: int) -> DataFrame:
    """The leaves of blocks: ``source, pos, digest, path`` and the payload, one row each."""
    schema = T.StructType().add("source", "string").add("pos", "long").add("digest", "binary").add("path", "binary")
    for name in payload:
        schema = schema.add(name, blocks.schema[name].dataType.elementType)

    def make():
        def step(batch: pa.RecordBatch):
            for row in batch.to_pylist():
                digests, paths = _leaves_of(row, height)
                for at in range(0, len(digests), PROOF_ROWS):
                    part = slice(at, min(at + PROOF_ROWS, len(digests)))
                    size = part.stop - at
                    columns = [
                        pa.array([row["source"]] * size, pa.string()),
                        pa.array(np.arange(at, part.stop, dtype=np.int64) + row["block"] * ARITY**height),
                        pa.array(digests[part], pa.binary()), pa.array(paths[part], pa.binary()),
                    ]
                    columns += [pa.array(row[name][part], batch.schema.field(name).type.value_type) for name in payload]
                    yield pa.RecordBatch.from_arrays(columns, schema.names)

        return step

    return arrow_stage(blocks.select("source", "block", "n", "size", "nodes", "above", *payload), make, schema)


def _leaves_of(row: dict, most: int) -> tuple[list[bytes], list[bytes]]:
    """Digests and whole paths of a block's leaves."""
    height, size = height_of(row["n"], most), row["size"]
    table = np.frombuffer(row["nodes"], np.uint8).reshape(-1, DIGEST)
    raw = table[addresses(height)[0][:size]].tobytes()
    digests = [raw[i : i + DIGEST] for i in range(0, len(raw), DIGEST)]
    return digests, [path + row["above"] for path in local_paths(row["nodes"], size, height)]


def proofs(manifest: Manifest) -> DataFrame:
    """Every leaf with its proof: ``source, pos, digest, path, id, other``."""
    return _members(_with_roots(manifest), ["id", "other"], manifest.height)


def _with_roots(manifest: Manifest) -> DataFrame:
    return _descend(manifest.layers, manifest.sources, manifest.height)


def verify(manifest: Manifest) -> DataFrame:
    """Per leaf: ``id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified``.

    ``folded_root`` follows from the tampered leaf, or the own one where nothing was
    tampered with, and the original siblings; ``verified`` says that it is the root.
    """
    height = manifest.height
    id_type = manifest.layers[0].schema["id"].dataType.elementType
    schema = T.StructType().add("id", id_type)
    for name in ("leaf", "subroot", "root", "proof_sha256", "folded_root"):
        schema = schema.add(name, "string")
    schema = schema.add("verified", "boolean")

    def make():
        def step(batch: pa.RecordBatch):
            kind = batch.schema.field("id").type.value_type
            for row in batch.to_pylist():
                digests, paths = _leaves_of(row, height)
                size, root = len(digests), row["root"].hex()
                folded = [fold(d if o is None else o, p).hex() for d, o, p in zip(digests, row["other"], paths, strict=True)]
                columns = [
                    pa.array(row["id"], kind), pa.array([d.hex() for d in digests]), pa.array([row["subroot"].hex()] * size),
                    pa.array([root] * size), pa.array([proof_digest(p) for p in paths]), pa.array(folded),
                    pa.array([f == root for f in folded]),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

        return step

    roots = manifest.sources.select(F.col("source").alias("_source"), "subroot", "root")
    blocks = _with_roots(manifest).drop("root")
    joined = blocks.join(roots, F.col("source").eqNullSafe(F.col("_source")))
    return arrow_stage(joined.select("source", "block", "n", "size", "nodes", "above", "id", "other", "subroot", "root"), make, schema)
