"""Exact top-k inner-product search as a Voronoi kNN join.

The largest inner products are the nearest neighbours once every vector gets one more
component that brings all to the same length (queries get 0). Data and queries are
grouped by their nearest pivot in that space. From bounded summaries (per data group
the ``k + 1`` smallest distances to its pivot, per query group the largest) comes a
bound on the distance of any query's k-th neighbour; a vector is copied only to the
query groups whose bound its distance does not exceed. Groups are cut into cells of
bounded size, every cell is solved exactly in integers, and cell results are merged.

Defined cases: vectors that are NULL, have a NULL id, or hold NULL, non-finite or (after
scaling) over 31-bit components take no part. Vectors of different lengths are
compared as if the shorter ended in zeros. A query is never its own candidate, nor is
any row with its id. Equal scores go to the smaller id; repeated rows are candidates
each. Fewer candidates than ``k`` give fewer rows. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import arrow_stage, ship_package, stored

MOST_PIVOTS = 64
CELL_DATA = 16_384
CELL_QUERIES = 512
SLACK = 1e-6


def quantised(vector: Column, scale: float) -> Column:
    """``floor(scale * x)`` per component as ``array<int>``; NULL if the vector takes no part."""
    scaled = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * scale) >= 2.0**31))
    return F.when(vector.isNotNull() & ~bad, F.transform(scaled, lambda x: x.cast("int")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    raw = column.to_pylist()
    out = np.zeros((len(raw), width))
    for i, x in enumerate(raw):
        out[i, : len(x) // 4] = np.frombuffer(x, "<i4")
    return out


def _distances(matrix: np.ndarray, top: float, pivots: np.ndarray, data: bool) -> np.ndarray:
    """To every pivot, in the space with one component more."""
    norms = (matrix**2).sum(axis=1)
    last = np.sqrt(np.maximum(top - norms, 0)) if data else np.zeros(len(matrix))
    full = np.column_stack([matrix, last])
    square = (full**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * full @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def _packed(vectors: DataFrame) -> DataFrame:
    def make():
        def step(batch: pa.RecordBatch):
            rows = [np.array(v, "<i4") for v in batch.column("vec").to_pylist()]
            square = [float((v.astype(float) ** 2).sum()) for v in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("is_query"), pa.array([v.tobytes() for v in rows], pa.binary()), pa.array(square)],
                ["id", "is_query", "vec", "square"],
            )

        return step

    return arrow_stage(vectors, make, "id long, is_query boolean, vec binary, square double")


def _grouped(rows: DataFrame, pivots: np.ndarray, width: int, top: float, data: bool) -> DataFrame:
    """``grp`` (nearest pivot) and ``dist`` to it."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def make():
        def step(batch: pa.RecordBatch):
            dist = _distances(_matrix(batch.column("vec"), width), top, shared.value, data)
            near = dist.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vec"), pa.array(near.astype(np.int32)), pa.array(dist[np.arange(len(near)), near])],
                ["id", "vec", "grp", "dist"],
            )

        return step

    return arrow_stage(rows.select("id", "vec"), make, "id long, vec binary, grp int, dist double")


def _replicated(rows: DataFrame, pivots: np.ndarray, width: int, top: float, reach: dict[int, float]) -> DataFrame:
    """Data rows once per query group ``grp`` they may matter to: those within ``reach`` of its pivot."""
    shared = rows.sparkSession.sparkContext.broadcast((pivots, np.array(sorted(reach)), np.array([reach[g] for g in sorted(reach)])))

    def make():
        pivots, groups, most = shared.value

        def step(batch: pa.RecordBatch):
            dist = _distances(_matrix(batch.column("vec"), width), top, pivots[groups], True)
            row, group = np.nonzero(dist <= most[None, :])
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("vec").take(at), pa.array(groups[group].astype(np.int32))],
                ["id", "vec", "grp"],
            )

        return step

    return arrow_stage(rows.select("id", "vec"), make, "id long, vec binary, grp int")


def solve_cell(queries: pd.DataFrame, data: pd.DataFrame, k: int, width: int) -> pd.DataFrame:
    """Best ``k`` of the cell's data for each of its queries, exact in 64-bit integers."""
    data = data.sort_values("id", kind="stable")
    x, q = (_matrix(pa.array(d["vec"].tolist(), pa.binary()), width) for d in (data, queries))
    exact = math.sqrt((x**2).sum(axis=1).max() * (q**2).sum(axis=1).max()) < 2.0**52
    scores = (q @ x.T).astype(np.int64) if exact else q.astype(np.int64) @ x.astype(np.int64).T
    ids = data["id"].to_numpy()
    out = []
    for own, row in zip(queries["id"], scores, strict=True):
        others = np.flatnonzero(ids != own)
        row = row[others]
        if len(row) > k:
            least = np.partition(row, len(row) - k)[len(row) - k]
            over = np.flatnonzero(row > least)
            at = np.concatenate([over, np.flatnonzero(row == least)[: k - len(over)]])
        else:
            at = np.arange(len(row))
        out.append(pd.DataFrame({"query_id": own, "vec_id": ids[others[at]], "score": row[at]}))
    return pd.concat(out)


def top_k(
    vectors: DataFrame, is_query: Column, k: int, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the ``k`` largest inner products of each query."""
    spark = vectors.sparkSession
    ship_package(spark)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), is_query.alias("is_query"), quantised(F.col(vector_col), scale).alias("vec")
    ).where("id is not null and vec is not null")
    rows = stored(_packed(rows), "vectors")
    facts = rows.agg(
        F.max(F.octet_length("vec")).alias("bytes"), F.max("square").alias("top"), F.count_if("is_query").alias("queries")
    ).first()
    if not facts.queries:
        return empty
    width, top = max(facts.bytes // 4, 1), facts.top
    count = min(MOST_PIVOTS, math.ceil(math.sqrt(facts.queries) / 2))
    chosen = rows.orderBy(F.xxhash64("id"), "vec").limit(count).toPandas()
    base = _matrix(pa.array(chosen["vec"].tolist(), pa.binary()), width)
    pivots = np.column_stack([base, np.sqrt(np.maximum(top - (base**2).sum(axis=1), 0))])
    pivots = np.unique(pivots, axis=0)

    data = _grouped(rows, pivots, width, top, True)
    order = Window.partitionBy("grp").orderBy("dist")
    # Per id once: of the k + 1 rows that make the bound at most one is the query's own.
    nearest = data.groupBy("grp", "id").agg(F.min("dist").alias("dist")).withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    nearest = nearest.select("grp", "dist").toPandas()
    asked = stored(_grouped(rows.where("is_query"), pivots, width, top, False), "queries")
    groups = asked.groupBy("grp").agg(F.max("dist").alias("far"), F.count("*").alias("n")).toPandas()
    between = np.sqrt(np.maximum(((pivots[:, None] - pivots[None]) ** 2).sum(axis=2), 0))
    reach = {}
    for grp, far in zip(groups["grp"], groups["far"], strict=True):
        above = np.sort(far + between[grp, nearest["grp"]] + nearest["dist"])
        bound = above[k] if len(above) > k else np.inf
        reach[int(grp)] = (bound + far) * (1 + SLACK) + SLACK * math.sqrt(top + 1)

    near = _replicated(rows, pivots, width, top, reach)
    near = stored(near, "replicas")
    sizes = {int(r["grp"]): int(r["n"]) for r in near.groupBy("grp").agg(F.count("*").alias("n")).collect()}
    splits = {int(g): (-(-sizes.get(int(g), 0) // CELL_DATA) or 1, -(-int(n) // CELL_QUERIES)) for g, n in zip(groups["grp"], groups["n"], strict=True)}
    cuts = [F.create_map(*[F.lit(x) for g, s in splits.items() for x in (g, s[i])])[F.col("grp")] for i in (0, 1)]
    hashed = F.xxhash64("id", "vec")

    def spread(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    left = asked.select("id", "vec", "grp", F.pmod(hashed, cuts[1]).cast("int").alias("q"), spread(cuts[0]).alias("d"))
    right = near.select("id", "vec", "grp", F.pmod(hashed, cuts[0]).cast("int").alias("d"), spread(cuts[1]).alias("q"))
    key = ["grp", "d", "q"]

    def solve(queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(data):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "vec_id", "score")})
        return solve_cell(queries, data, k, width)

    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(solve, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
