"""Embedding near-dedup: an exact metric range join by angle.

Two vectors link when their cosine is at least ``THRESHOLD``, that is when their angle, a metric, is at most r = acos(THRESHOLD).
A bounded sample gives pivots more than r apart (their number grows with the table up to ``MAX_PIVOTS``, larger cells being
sliced). A vector's home is the cell of its nearest pivot, and in it the core (within r / 2 of the pivot) or the shell.
The least and largest angle to the pivot of each core and shell, two numbers and a count each, reach the driver. By the
triangle inequality a vector can only link with rows of another core or shell if its angle to that pivot is within r of
those bounds and at most 2 r beyond its angle to its own pivot; where it can, it visits (of two cells the rows of the wider visit
the narrower, so a pair is compared once). All rows of a core link with each other by the same
inequality, so a group of copies about a pivot is counted and never compared.

Cells join independently: home rows and visitors are cut into slices of about ``SLICE`` rows, and a task compares two slices by
single-precision products; those within 1e-5 of the threshold are decided in double precision. A task returns for each row its
number of links there and one edge to the least vec_id of what it is connected with in the task, so rows that all link give
as many edges as rows. ``components`` joins the edges.

On vectors without structure all angles are alike, the bounds keep little apart and every two slices meet: that is n^2 / 2
comparisons, shipped as n / SLICE copies of a row at most.

Defined results: vectors that are null, empty, zero, hold null or non-finite components or have another length than most
(the smaller of equally frequent ones) link with nothing, nor do rows without a vec_id; they are returned with n_links 0
and component_id = vec_id. Rows repeated with one vec_id stand alone in the result, n_links counts linked rows other than
itself (those of its vec_id too), and for components they are one vector. Equal vectors link. Extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtable.llm.common import read_table, settle
from tagtable.llm.components import components
from tagtable.llm.vectors import dimension_of, matrix, sample, usable

THRESHOLD = 0.9
MIN_PIVOTS, MAX_PIVOTS, ROWS_PER_PIVOT = 16, 512, 16384
SLICE = 16384
ALLOW = 1e-6  # of an angle, for rounding
NEAR = 1e-5  # of a cosine in single precision
SUB = 1024


def units(x: np.ndarray) -> np.ndarray:
    """Rows of finite components, not all zero, scaled to length 1 in double precision."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, initial=0, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def angles(u: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(u @ pivots.T, -1, 1))


def spread_pivots(rows: DataFrame, n: int, radius: float) -> np.ndarray:
    """At most n unit vectors of a sample, each farther than ``radius`` from those before it."""
    u = units(sample(rows.withColumnRenamed("uid", "vec_id"), 4 * n))
    kept = [0]
    for i in range(1, len(u)):
        if len(kept) < n and angles(u[i : i + 1], u[kept]).min() > radius:
            kept.append(i)
    return u[kept]


def _homes(u: np.ndarray, pivots: np.ndarray, radius: float):
    """Angles to all pivots, number of the home (2 x cell, + 1 for the shell) and angle to its pivot."""
    far = angles(u, pivots)
    cell = far.argmin(1)
    own = far[np.arange(len(u)), cell]
    return far, 2 * cell + (own > radius / 2 - ALLOW), own


def _rows_of(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch["embedding"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def visits(far: np.ndarray, home: np.ndarray, own: np.ndarray, low: np.ndarray, high: np.ndarray, radius: float) -> np.ndarray:
    """Which homes (columns) each row must visit. A home without rows has low > high."""
    reach = radius + ALLOW
    to = np.repeat(far, 2, axis=1)
    meets = (to >= low - reach) & (to <= high + reach) & (to <= own[:, None] + 2 * reach) & (low <= high)
    order = np.lexsort((np.arange(len(high)), high))  # narrow first
    rank = np.empty(len(high), int)
    rank[order] = np.arange(len(high))
    return meets & (rank[None] < rank[home][:, None])


def linked(left: np.ndarray, right: np.ndarray | None, threshold: float):
    """(from, to, links) by blocks of left rows: links[i, j] of rows from + i of left and j of right; right None: of left itself."""
    lu = units(left)
    ru = lu if right is None else units(right)
    ls, rs = lu.astype(np.float32), ru.astype(np.float32)
    for a in range(0, len(ls), SUB):
        first = a if right is None else 0  # each pair of one slice once
        g = ls[a : a + SUB] @ rs[first:].T
        hit = g >= threshold + NEAR
        close = np.argwhere(~hit & (g >= threshold - NEAR))
        for c in range(0, len(close), 1 << 16):
            i, j = close[c : c + (1 << 16)].T
            hit[i, j] = (lu[a + i] * ru[first + j]).sum(1) >= threshold
        if right is None:
            hit &= np.arange(first, len(rs))[None] > np.arange(a, a + len(g))[:, None]
        yield a, first, hit


def tile(left: np.ndarray, right: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Number of links and label of each row, left ones then right ones; rows that links connect have one label."""
    base = 0 if right is None else len(left)
    n = len(left) + (0 if right is None else len(right))
    counts, labels = np.zeros(n, np.int64), np.arange(n)
    for a, first, hit in linked(left, right, threshold):
        counts[a : a + len(hit)] += hit.sum(1)
        counts[base + first : base + first + hit.shape[1]] += hit.sum(0)
        for i in np.flatnonzero(hit.any(1)).tolist():
            mine = labels[np.append(base + first + np.flatnonzero(hit[i]), a + i)]
            if (mine != mine[0]).any():
                into = np.arange(n)
                into[mine] = mine.min()
                labels = into[labels]
    return counts, labels


def range_join(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each of ``rows``."""
    spark = rows.sparkSession
    radius = float(np.arccos(threshold))
    base = settle(rows.select("vec_id", "embedding")).withColumn("uid", F.monotonically_increasing_id())
    good = usable(base, zero=False, keep=("uid",)).select("uid", F.col("vec_id").alias("name"), "embedding")
    dim = dimension_of(good)
    single = "double" not in dict(rows.dtypes)["embedding"]
    dtype = np.float32 if single else np.float64
    none = base.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not dim:
        return none
    good = good.where(F.size("embedding") == dim)
    n = good.count()
    pivots = spread_pivots(good, min(MAX_PIVOTS, max(MIN_PIVOTS, n // ROWS_PER_PIVOT)), radius)
    shared = spark.sparkContext.broadcast(pivots)  # at most MAX_PIVOTS vectors

    def summary(batches):
        for batch in batches:
            _, home, own = _homes(units(_rows_of(batch, dim)), shared.value, radius)
            yield pa.record_batch({"uid": batch["uid"], "name": batch["name"], "home": pa.array(home.astype(np.int32)), "own": pa.array(own)})

    counted = good.mapInArrow(summary, "uid long, name long, home int, own double").groupBy("home").agg(
        F.min("own").alias("low"), F.max("own").alias("high"), F.count("*").alias("n"), F.min("name").alias("name")).collect()  # two rows a pivot
    low, high = np.full(2 * len(pivots), np.inf), np.full(2 * len(pivots), -np.inf)
    for r in counted:
        low[r["home"]], high[r["home"]] = r["low"], r["high"]

    def place(batches):
        for batch in batches:
            x = _rows_of(batch, dim).astype(dtype)
            far, home, own = _homes(units(x), shared.value, radius)
            row, to = np.nonzero(visits(far, home, own, low, high, radius))
            offsets = np.searchsorted(row, np.arange(len(x) + 1)).astype(np.int32)
            yield pa.record_batch({"uid": batch["uid"], "name": batch["name"], "vec": pa.array([r.tobytes() for r in x], pa.binary()),
                                   "home": pa.array(home.astype(np.int32)), "visits": pa.ListArray.from_arrays(pa.array(offsets), pa.array(to.astype(np.int32)))})

    placed = settle(good.mapInArrow(place, "uid long, name long, vec binary, home int, visits array<int>"))
    visitors = {r["home"]: r["n"] for r in placed.select(F.explode("visits").alias("home")).groupBy("home").agg(F.count("*").alias("n")).collect()}
    slices = [(r["home"], -(-r["n"] // SLICE), -(-visitors.get(r["home"], 0) // SLICE), r["home"] % 2 == 0) for r in counted]
    plan = F.broadcast(spark.createDataFrame(slices, "home int, own int, guests int, core boolean"))  # a row a home
    cut = lambda c: F.pmod(F.xxhash64("uid"), F.col(c)).cast("int")
    upto = lambda a, b: F.when(a < b, F.sequence(a, b - 1)).otherwise(F.expr("CAST(array() AS array<int>)"))
    cols = ["uid", "name", "vec", "home"]
    # a task compares home slice ``a`` with slice ``b``: of the home (b < own) or of the visitors (from own on)
    ours = placed.join(plan, "home").withColumn("s", cut("own"))
    first = F.when(F.col("core"), F.col("own")).otherwise(F.col("s"))
    as_left = ours.select(*cols, F.col("s").alias("a"), F.explode(upto(first, F.col("own") + F.col("guests"))).alias("b"), F.lit(True).alias("left"))
    as_right = ours.where("NOT core").select(*cols, F.explode(upto(F.lit(0), F.col("s"))).alias("a"), F.col("s").alias("b"), F.lit(False).alias("left"))
    guests = placed.select("uid", "name", "vec", F.explode("visits").alias("home")).join(plan, "home").withColumn("b", F.col("own") + cut("guests"))
    guests = guests.select(*cols, F.explode(upto(F.lit(0), F.col("own"))).alias("a"), "b", F.lit(False).alias("left"))

    def solve(key, t):
        mark = t["left"].to_numpy()
        x = matrix(t["vec"], dtype, dim)
        order = np.argsort(~mark, kind="stable")
        m = int(mark.sum())
        same = m == len(x)
        if not m or (same and m < 2):
            return pa.table({"uid": pa.array([], pa.int64()), "name": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "least": pa.array([], pa.int64())})
        counts, labels = tile(x[order[:m]], None if same else x[order[m:]], threshold)
        uid, name = t["uid"].to_numpy()[order], t["name"].to_numpy()[order]
        least = np.full(len(uid), np.iinfo(np.int64).max)
        np.minimum.at(least, labels, name)
        at = np.flatnonzero(counts)
        return pa.table({"uid": pa.array(uid[at]), "name": pa.array(name[at]), "n": pa.array(counts[at]), "least": pa.array(least[labels[at]])})

    tiles = as_left.unionByName(as_right).unionByName(guests).groupBy("home", "a", "b")
    cores = [(r["home"], r["n"] - 1, r["name"]) for r in counted if r["home"] % 2 == 0 and r["n"] > 1]
    within = placed.select("uid", "name", "home").join(F.broadcast(spark.createDataFrame(cores, "home int, n long, least long")), "home")
    found = settle(tiles.applyInArrow(solve, "uid long, name long, n long, least long").unionByName(within.drop("home")))
    label = components(found.select(F.col("name").alias("a"), F.col("least").alias("b")))
    counts = found.groupBy("uid").agg(F.sum("n").alias("n_links"))
    out = base.select("uid", "vec_id").join(counts, "uid", "left").join(label.select(F.col("node").alias("vec_id"), "label"), "vec_id", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("label", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op11(spark, sf_dir: str) -> DataFrame:
    return range_join(read_table(spark, sf_dir, "embeddings"))
