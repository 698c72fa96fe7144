"""Helpers for tables of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(rows: DataFrame, zero: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (vec_id, embedding) with an id and finite components only; with ``zero=False`` no zero vectors either. Columns
    named in ``keep`` stay."""
    x = F.col("embedding")
    good = F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0)
    good &= F.forall(x, lambda v: F.coalesce(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    if not zero:
        good &= F.exists(x, lambda v: v != 0)
    return rows.select("vec_id", "embedding", *keep).where(good)


def sample(rows: DataFrame, n: int, dimension: int | None = None) -> np.ndarray:
    """At most n different vectors, those with the smallest hashes: the same at each run, and a bounded number of rows."""
    if dimension is not None:
        rows = rows.where(F.size("embedding") == dimension)
    few = rows.select("embedding", F.xxhash64("vec_id").alias("h")).orderBy("h").limit(4 * n).select("embedding").collect()
    seen = dict.fromkeys(tuple(r[0]) for r in few)
    return np.array(list(seen)[:n], np.float64)


def dimension_of(rows: DataFrame) -> int:
    """The most frequent length (the smaller of equals); 0 without rows."""
    r = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return r["d"] if r else 0


def matrix(column: pa.ChunkedArray, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids; scores of -inf take no part."""
    n = int((scores > -np.inf).sum())
    if n > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= kth)
    else:
        at = np.flatnonzero(scores > -np.inf)
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def merge_best(found: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score) of several parts -> query_id, rank, vec_id, score. A query has k rows from each part."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
