"""Approximate nearest neighbours by a permutation index.

A bounded sample gives pivots, ``PIVOT_RATE`` times the square root of the number of rows (within ``MIN_PIVOTS`` and ``MAX_PIVOTS``). A vector orders
them by inner product, nearest first, and keeps both ends of that permutation: its ``PREFIX`` nearest pivots in order, and its
``PREFIX`` farthest ones in order. Rows are dealt to shards by hash; in a shard each pivot has two inverted files,
of the rows that name it as near or as far, with its place in their order. Only the files of a query's own pivots are
read, for a block of queries at a time: the Spearman footrule of two such lists (a pivot missing from a list stands at its end)
is a constant minus twice the sum of PREFIX - max(place, place) over common pivots. The best ``SHARE`` of a
shard by footrule, with every row that ties with the last of them, is reranked by the inner product in double precision on the original vectors, summed from the first
component to the last so that equal vectors score equal everywhere. Shards send k rows for each query.

Queries (rows whose vec_id is divisible by ``EVERY``) go against all shards; every row is indexed, in one shard, and is shipped once for
``QUERY_BLOCK`` queries. SHARE is the same share at every size, not a cap, so recall does not fall as the input grows; README has the recall measured against brute force.

Vectors that are null, zero or hold null or non-finite components take no part, nor do rows without a vec_id or with
another length than most. Rows with the query's vec_id are never its neighbours; of rows repeated with one vec_id one is the
query (the least by its bytes). Ties go to the smaller vec_id; fewer candidates than k are all returned (a shard reranks 2 k rows
at least). Extra columns are ignored; no queries, no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtable.llm.common import read_table, settle
from tagtable.llm.vectors import dimension_of, matrix, merge_best, sample, usable

K, EVERY = 20, 20
PIVOT_RATE, MIN_PIVOTS, MAX_PIVOTS, PREFIX = 10, 256, 2048, 48
SHARE = 0.15
SHARD_ROWS, QUERY_BLOCK = 4096, 16384
AT_ONCE = 512  # queries of a block whose footrules are held at once


def ends(sim: np.ndarray, prefix: int) -> np.ndarray:
    """The prefix nearest pivots of each row in order, then the prefix farthest ones in order (numbered from the number of pivots on)."""
    n = sim.shape[1]

    def first(s):
        at = np.argpartition(s, prefix - 1, axis=1)[:, :prefix] if prefix < n else np.broadcast_to(np.arange(n), s.shape)
        at = np.sort(at, axis=1)
        return np.take_along_axis(at, np.argsort(np.take_along_axis(s, at, 1), axis=1, kind="stable"), 1)

    return np.hstack([first(-sim), n + first(sim)])


def _orders(pivots: np.ndarray, prefix: int):
    def run(batches):
        for batch in batches:
            x = batch["embedding"].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            near = ends(x @ pivots.T, prefix).astype(np.uint16)
            yield pa.record_batch({"vec_id": batch["vec_id"], "vec": pa.array([r.tobytes() for r in x], pa.binary()), "pivots": pa.array([r.tobytes() for r in near], pa.binary())})

    return run


def inverted_files(near: np.ndarray, n_files: int):
    """For each pivot, near and far: the rows that name it and prefix minus its place in their order."""
    prefix = near.shape[1] // 2
    flat = near.reshape(-1)
    order = np.argsort(flat, kind="stable")
    edge = np.searchsorted(flat[order], np.arange(n_files + 1))
    rows, weight = order // near.shape[1], (prefix - order % near.shape[1] % prefix).astype(np.int16)
    return [(rows[a:b], weight[a:b]) for a, b in zip(edge, edge[1:])]


def nearness(asked, files, n_asked: int, n: int) -> np.ndarray:
    """Queries x rows: sum of prefix - max(place, place) over common pivots; larger is a smaller footrule distance."""
    total = np.zeros((n_asked, n), np.int16)
    for (q, q_weight), (rows, weight) in zip(asked, files):
        if len(q) and len(rows):
            total[np.ix_(q, rows)] += np.minimum(q_weight[:, None], weight[None])
    return total


def reranked(near: np.ndarray, m: int) -> np.ndarray:
    """Places of the m nearest rows and of all that are as near as the last of them, so equal vectors stay together."""
    if m >= len(near):
        return np.arange(len(near))
    return np.flatnonzero(near >= np.partition(near, len(near) - m)[len(near) - m])


def inner(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of rows with rows, component by component in order."""
    total = np.zeros(len(x))
    for c in range(x.shape[1]):
        total += x[:, c] * q[:, c]
    return total


def build_index(rows: DataFrame, prefix: int = PREFIX) -> tuple[DataFrame, int, int]:
    """(vec_id, vec, pivots) of every usable row, the number of pivots and the vector length."""
    good = usable(rows, zero=False)
    dim = dimension_of(good)
    if not dim:
        return rows.sparkSession.createDataFrame([], "vec_id long, vec binary, pivots binary"), 0, 0
    good = good.where(F.size("embedding") == dim)
    wanted = min(MAX_PIVOTS, max(MIN_PIVOTS, int(PIVOT_RATE * good.count() ** 0.5)))
    p = sample(good, wanted)
    return settle(good.mapInArrow(_orders(p, min(prefix, len(p))), "vec_id long, vec binary, pivots binary")), len(p), dim


def search(rows: DataFrame, k: int = K, every: int = EVERY, share: float = SHARE) -> DataFrame:
    index, n_pivots, dim = build_index(rows)
    width = 2 * min(PREFIX, n_pivots)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    n = index.count()
    shards = max(1, -(-n // SHARD_ROWS), min(cores, n // 1024))
    queries = index.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min(F.struct("vec", "pivots")).alias("q")).select(
        F.col("vec_id").alias("query_id"), F.col("q.vec").alias("q_vec"), F.col("q.pivots").alias("q_pivots"))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    shard = F.pmod(F.xxhash64("vec_id", "vec"), F.lit(shards)).cast("int")
    every_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    data = index.select("*", shard.alias("shard"), every_of(blocks).alias("block"))
    asked = queries.select("*", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"), every_of(shards).alias("shard"))

    def run(key, q, d):
        out = []
        if q.num_rows and d.num_rows:
            ids, x = d["vec_id"].to_numpy(), matrix(d["vec"], np.float64, dim)
            files = inverted_files(matrix(d["pivots"], np.uint16, width), 2 * n_pivots)
            most = float(np.sqrt((x * x).sum(1).max()))
            m = min(len(ids), max(2 * k, int(np.ceil(share * len(ids)))))
            for a in range(0, q.num_rows, AT_ONCE):
                part = q.slice(a, AT_ONCE)
                qid, qv, order = part["query_id"].to_numpy(), matrix(part["q_vec"], np.float64, dim), matrix(part["q_pivots"], np.uint16, width)
                near = nearness(inverted_files(order, 2 * n_pivots), files, len(qid), len(ids))
                places = []
                for i, row in enumerate(near):
                    at = reranked(row, m)
                    at = at[ids[at] != qid[i]]
                    rough = x[at] @ qv[i]
                    if len(at) > k:  # the exact sum decides among all that rounding could bring in
                        kth = np.partition(rough, len(rough) - k)[len(rough) - k]
                        at = at[rough >= kth - 1e-13 * dim * most * float(np.sqrt(qv[i] @ qv[i]))]
                    places.append(at)
                which = np.repeat(np.arange(len(qid)), [len(at) for at in places])
                at = np.concatenate(places)
                exact = inner(x[at], qv[which])
                order = np.lexsort((ids[at], -exact, which))
                first = np.searchsorted(which, np.arange(len(qid)))
                kept = order[np.arange(len(order)) - first[which] < k]  # ``which`` is sorted: order keeps its queries in place
                out.append((qid[which[kept]], ids[at[kept]], exact[kept]))
        if not out:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return pa.table({c: pa.array(np.concatenate(v)) for c, v in zip(("query_id", "vec_id", "score"), zip(*out))})

    key = ["shard", "block"]
    return merge_best(asked.groupBy(key).cogroup(data.groupBy(key)).applyInArrow(run, "query_id long, vec_id long, score double"), k)


def op10(spark, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "embeddings"))
