"""Exact top-k search by inner product: a Voronoi kNN join.

The largest inner product is the nearest neighbour once a vector s is extended by sqrt(M^2 - |s|^2) (M: the largest norm)
and a query by 0. A bounded sample of rows gives the pivots, one for each block of
queries (8 to 512); data and queries belong to the cell of their nearest pivot. Two summaries reach the driver, of fixed size for each pivot: the k + 1 smallest distances of a cell's data to its pivot, each
from another vec_id, and the largest distance of a cell's queries to theirs. They bound, for every query cell, the distance
of the k-th neighbour (one of k + 1 vec_ids may be the query's own, however many rows it has); the triangle inequality then says which data can matter to that cell, and only those are replicated to it. Cells are
cut into blocks of queries and slices of data of bounded size; a task solves one block against one slice and sends k
rows for each query. The bounds are loosened by a rounding allowance, scores are whole numbers and exact.

Components become floor(1024 * x) before all else. Queries are rows whose vec_id is divisible by ``EVERY``; candidates all
rows with another vec_id. Vectors that are null or hold null or non-finite components take no part, nor do rows without
a vec_id or with another length than most. Of rows repeated with one vec_id one is the query (the least by its bytes) and all are candidates.
Ties go to the smaller vec_id; fewer candidates than k are all returned. Extra columns are ignored; no queries, no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtable.llm.common import read_table, settle
from tagtable.llm.vectors import best, dimension_of, matrix, merge_best, sample, usable

K, EVERY, SCALE = 10, 100, 1024
LEAST_PIVOTS, MOST_PIVOTS = 8, 512  # the plan has a row for two pivots: 262,144 rows at most
QUERY_BLOCK, DATA_SLICE = 512, 8192


def _cells(pivots: np.ndarray, top: float, scale: int):
    """Cell and distance to its pivot of each row, as data (extended) and as query."""

    def place(batches):
        for batch in batches:
            x = np.floor(scale * batch["embedding"].flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(batch.num_rows, -1)
            norms = (x * x).sum(1)
            last = np.sqrt(np.maximum(top - norms, 0))
            out = {"vec_id": batch["vec_id"], "vec": pa.array([r.tobytes() for r in x], pa.binary())}
            for name, extra in (("", last), ("q_", np.zeros(len(x)))):
                d = np.sqrt(np.maximum(((pivots * pivots).sum(1) + (norms + extra**2)[:, None]) - 2 * (x @ pivots[:, :-1].T + np.outer(extra, pivots[:, -1])), 0))
                cell = d.argmin(1) if len(x) else np.zeros(0, int)
                out[name + "cell"], out[name + "far"] = pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(x)), cell])
            yield pa.record_batch(out)

    return place


def least_of_each(ids: np.ndarray, far: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n vec_ids with the smallest distances and the smallest distance of each, in order."""
    order = np.lexsort((ids, far))
    first = np.sort(np.unique(ids[order], return_index=True)[1])[:n]
    return ids[order][first], far[order][first]


def bounds(pivots: np.ndarray, nearest: dict[int, list[tuple[int, float]]], reach: dict[int, float], k: int) -> dict[int, float]:
    """For each query cell, a distance within which every one of its queries has k neighbours of other vec_ids: k + 1
    different vec_ids lie within it. ``nearest`` has (vec_id, distance) pairs of each data cell."""
    gap = np.sqrt(((pivots[:, None] - pivots[None]) ** 2).sum(2))
    ids = np.array([v for r in nearest.values() for v, _ in r], np.int64)
    out = {}
    for i, u in reach.items():
        ub = np.array([d + u + gap[i, j] for j, r in nearest.items() for _, d in r])
        ub = least_of_each(ids, ub, k + 1)[1]
        out[i] = float(ub[k]) if len(ub) > k else float("inf")
    return out


def pivots_for(queries: int) -> int:
    """A pivot for each block of queries, so that where no bound excludes anything data travel no more often than there are blocks."""
    return min(MOST_PIVOTS, max(LEAST_PIVOTS, queries // QUERY_BLOCK))


def knn_join(rows: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, pivots: int | None = None) -> DataFrame:
    spark = rows.sparkSession
    good = usable(rows)
    dim = dimension_of(good)
    schema = "query_id long, vec_id long, score long"
    if not dim:
        return spark.createDataFrame([], schema).selectExpr("query_id", "1 AS rank", "vec_id", "score")
    good = good.where(F.size("embedding") == dim)
    whole = F.transform("embedding", lambda v: F.floor(F.lit(float(scale)) * v.cast("double")).cast("double"))
    top, asking = good.agg(F.max(F.aggregate(whole, F.lit(0.0), lambda a, v: a + v * v)), F.count_if(F.pmod("vec_id", F.lit(every)) == 0)).first()
    pivots = pivots or pivots_for(asking)
    p = np.floor(scale * sample(good, pivots))
    p = np.hstack([p, np.sqrt(np.maximum(top - (p * p).sum(1, keepdims=True), 0))])
    placed = settle(good.mapInArrow(_cells(p, top, scale), "vec_id long, vec binary, cell int, far double, q_cell int, q_far double"))
    queries = placed.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min(F.struct("vec", "q_cell", "q_far")).alias("q")).select(
        F.col("vec_id").alias("query_id"), F.col("q.vec").alias("q_vec"), F.col("q.q_cell").alias("for_cell"), F.col("q.q_far").alias("far"))

    def smallest(batches):
        low: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            ids, cell, far = (batch[c].to_numpy() for c in ("vec_id", "cell", "far"))
            for c in np.unique(cell).tolist():
                old_ids, old = low.get(c, (ids[:0], far[:0]))
                low[c] = least_of_each(np.concatenate([old_ids, ids[cell == c]]), np.concatenate([old, far[cell == c]]), k + 1)
        yield pa.record_batch({"vec_id": pa.array([v for x, _ in low.values() for v in x], pa.int64()), "cell": pa.array([c for c, (x, _) in low.items() for _ in x], pa.int32()),
                               "far": pa.array([v for _, x in low.values() for v in x], pa.float64())})

    nearest: dict[int, list[tuple[int, float]]] = {}
    least = placed.select("vec_id", "cell", "far").mapInArrow(smallest, "vec_id long, cell int, far double")
    least = least.groupBy("cell", "vec_id").agg(F.min("far").alias("far"))
    merged = least.withColumn("nth", F.expr("row_number() OVER (PARTITION BY cell ORDER BY far, vec_id)")).where(F.col("nth") <= k + 1)
    for r in merged.collect():  # k + 1 rows a pivot
        nearest.setdefault(r["cell"], []).append((r["vec_id"], r["far"]))
    counted = {r["for_cell"]: r for r in queries.groupBy("for_cell").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect()}
    if not counted:
        return spark.createDataFrame([], schema).selectExpr("query_id", "1 AS rank", "vec_id", "score")
    reach = {c: r["far"] for c, r in counted.items()}
    theta = bounds(p, nearest, reach, k)
    gap = np.sqrt(((p[:, None] - p[None]) ** 2).sum(2))
    slices = max(1, -(-placed.count() // DATA_SLICE))
    plan = [(j, i, float(gap[i, j] - reach[i] - theta[i]), float(gap[i, j] + reach[i] + theta[i]), -(-counted[i]["n"] // QUERY_BLOCK))
            for i in counted for j in nearest]  # pivots x pivots rows
    allow = 1e-6 * (1 + top**0.5)
    wanted = F.broadcast(spark.createDataFrame(plan, "cell int, for_cell int, low double, high double, blocks int"))
    data = (placed.join(wanted, "cell").where((F.col("far") >= F.col("low") - allow) & (F.col("far") <= F.col("high") + allow))
            .select("vec_id", "vec", "for_cell", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(slices)).cast("int").alias("part"),
                    F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
    blocks = F.broadcast(spark.createDataFrame([(i, -(-r["n"] // QUERY_BLOCK)) for i, r in counted.items()], "for_cell int, blocks int"))
    asked = (queries.join(blocks, "for_cell").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int"))
             .select("query_id", "q_vec", "for_cell", "block", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("part")))

    def solve(key, q, d):
        out = ([], [], [])
        if q.num_rows and d.num_rows:
            qi, di = q["query_id"].to_numpy(), d["vec_id"].to_numpy()
            scores = matrix(q["q_vec"], np.float64, dim) @ matrix(d["vec"], np.float64, dim).T  # whole numbers: exact
            scores[qi[:, None] == di[None]] = -np.inf
            for n, row in zip(qi.tolist(), scores):
                at = best(row, di, k)
                out[0].extend([n] * len(at))
                out[1].extend(di[at].tolist())
                out[2].extend(row[at].astype(np.int64).tolist())
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("query_id", "vec_id", "score"), out)})

    key = ["for_cell", "block", "part"]
    return merge_best(asked.groupBy(key).cogroup(data.groupBy(key)).applyInArrow(solve, schema), k)


def op8(spark, sf_dir: str) -> DataFrame:
    return knn_join(read_table(spark, sf_dir, "embeddings"))
