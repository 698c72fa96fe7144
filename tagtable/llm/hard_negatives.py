"""Hard negatives of anchors, scored by the method of Four Russians.

Components become whole numbers, floor(scale * x). A candidate is packed as bit planes: for each bit of the two's complement
(as many as the table's largest component needs) and each eight dimensions one byte. For an anchor the sums of all 256 subsets of
its components are tabulated for each eight dimensions; a plane's byte looks up what these bits add, the planes are added
with shifts from the highest down (the sign's plane counts negative), and the result is the exact inner product.

First each anchor's positives are found, its best ``POSITIVES`` rows of the same label. Then, for each positive with score p, its
negatives: the best ``NEGATIVES`` rows of another label with low * p <= 100 * score <= high * p (in percent). Candidates are dealt to
slices by a hash, so a label with any share of the rows is spread, and anchors to blocks; each slice returns at most so many
rows as asked for an anchor and positive. A slice meets all blocks of anchors: work grows with anchors x rows, as exact scores need, and
candidates are copied once for ``BLOCK`` anchors.

Defined results: rows without a vec_id, label or vector, with null or non-finite components, or with another length than
most (the smaller of equally frequent ones) take no part, nor do those with a component so large that a score could pass 64 bits
(dimension * v^2 >= 2^62). Zero vectors take part. Of rows repeated with one vec_id the least, by vector and label, is the
anchor; all of them are candidates for other anchors, and none for their own. Ties go to the smaller vec_id. An anchor without positives
or a positive without negatives has no rows. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtable.llm.common import read_table, settle
from tagtable.llm.vectors import dimension_of, matrix, usable

EVERY, SCALE = 100, 256
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
SLICE, BLOCK = 16384, 1024
GROUP = 8  # dimensions of a table


# ---- scoring

def bit_planes(v: np.ndarray, bits: int) -> np.ndarray:
    """Whole numbers (rows x dimensions) -> bytes (rows x bits x groups of eight dimensions), lowest bit first."""
    return np.stack([np.packbits((v >> b & 1).astype(np.uint8), axis=1, bitorder="little") for b in range(bits)], axis=1)


def subset_sums(v: np.ndarray) -> np.ndarray:
    """For each eight components of an anchor the sums of all their subsets (groups x 256)."""
    groups = np.pad(v, (0, -len(v) % GROUP)).reshape(-1, GROUP)
    sums = np.zeros((len(groups), 1 << GROUP), v.dtype)
    for j in range(GROUP):
        sums[:, 1 << j : 2 << j] = sums[:, : 1 << j] + groups[:, j : j + 1]
    return sums


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products of an anchor, by its tables, with candidates, by their planes (bits x groups x rows)."""
    total = np.zeros(planes.shape[2], sums.dtype)
    for b in range(len(planes) - 1, -1, -1):
        level = sums[0].take(planes[b, 0])
        for g in range(1, len(sums)):
            level += sums[g].take(planes[b, g])
        total = -level if b == len(planes) - 1 else (total << 1) + level
    return total


def first_of(score: np.ndarray, ids: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Of the places ``at`` the n with the highest scores, ties to smaller ids, best first."""
    if len(at) > n:
        s = score[at]
        at = at[s >= np.partition(s, len(s) - n)[len(s) - n]]
    return at[np.lexsort((ids[at], -score[at]))[:n]]


# ---- Spark

def _packed(rows: DataFrame, scale: int) -> tuple[DataFrame, int, int]:
    """(vec_id, label, whole, planes), the dimension and the number of bits."""
    good = usable(rows.where("label IS NOT NULL"), keep=("label",))
    dim = dimension_of(good)
    schema = "vec_id long, label long, whole binary, planes binary"
    if not dim:
        return rows.sparkSession.createDataFrame([], schema), 0, 0
    limit = int((2**62 / dim) ** 0.5)
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    largest = F.array_max(F.transform(whole, lambda x: F.abs(x + F.lit(0.5))))  # |v + 1/2| < 2^b: v needs b bits and a sign
    good = good.where(F.size("embedding") == dim).withColumn("largest", largest).where(F.col("largest") < limit)
    top = good.agg(F.max("largest")).first()[0]
    bits = 1 + int(np.ceil(np.log2((top or 0.5) + 0.5)))

    def pack(batches):
        for batch in batches:
            x = batch["embedding"].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            v = np.floor(scale * x).astype(np.int64)
            yield pa.record_batch({"vec_id": batch["vec_id"], "label": batch["label"].cast(pa.int64()), "whole": pa.array([r.tobytes() for r in v], pa.binary()),
                                   "planes": pa.array([r.tobytes() for r in bit_planes(v, bits)], pa.binary())})

    return settle(good.select("vec_id", "label", "embedding").mapInArrow(pack, schema)), dim, bits


def _spread(n: int):
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def mine(rows: DataFrame, every: int = EVERY, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank)."""
    spark = rows.sparkSession
    data, dim, bits = _packed(rows, scale)
    anchors = data.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min(F.struct("whole", "label")).alias("a"))
    anchors = anchors.select(F.col("vec_id").alias("anchor_id"), F.col("a.whole").alias("a_whole"), F.col("a.label").alias("a_label"))
    n, asked = data.count(), anchors.count()
    cores = spark.sparkContext.defaultParallelism
    slices, blocks = max(1, -(-n // SLICE), min(cores, n // 1024)), max(1, -(-asked // BLOCK))
    key = ["block", "slice"]
    groups = -(-dim // GROUP)
    kind = np.int32 if dim * 4**bits < 2**31 else np.int64
    candidates = data.select("vec_id", "label", "planes", F.pmod(F.xxhash64("vec_id", "planes"), F.lit(slices)).cast("int").alias("slice"), _spread(blocks).alias("block"))
    candidates = candidates.groupBy(*key)

    def dealt(a: DataFrame):
        return a.withColumn("block", F.pmod(F.xxhash64("anchor_id"), F.lit(blocks)).cast("int")).withColumn("slice", _spread(slices)).groupBy(*key)

    def by_label(t: pa.Table):
        """Ids, labels and planes (bits x groups x rows) in order of the labels."""
        ids, label = t["vec_id"].to_numpy(), t["label"].to_numpy()
        order = np.argsort(label, kind="stable")
        planes = matrix(t["planes"], np.uint8, bits * groups)[order].T.reshape(bits, groups, -1)
        return ids[order], label[order], np.ascontiguousarray(planes)

    def best_positives(key, a, t):
        out = ([], [], [])
        if a.num_rows and t.num_rows:
            ids, label, planes = by_label(t)
            for anchor, own, v in zip(a["anchor_id"].to_pylist(), a["a_label"].to_pylist(), matrix(a["a_whole"], np.int64, dim).astype(kind)):
                i, j = np.searchsorted(label, [own, own + 1])
                score = scores(subset_sums(v), planes[:, :, i:j])
                at = first_of(score, ids[i:j], np.flatnonzero(ids[i:j] != anchor), positives)
                for column, values in zip(out, ([anchor] * len(at), ids[i:j][at].tolist(), score[at].tolist())):
                    column.extend(values)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("anchor_id", "positive_id", "positive_score"), out)})

    found = dealt(anchors).cogroup(candidates).applyInArrow(best_positives, "anchor_id long, positive_id long, positive_score long")
    order = "row_number() OVER (PARTITION BY anchor_id ORDER BY positive_score DESC, positive_id)"
    found = found.withColumn("positive_rank", F.expr(order)).where(F.col("positive_rank") <= positives)
    of_anchor = found.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("positive_rank", "positive_id", "positive_score"))).alias("p"))  # ``positives`` at most
    asking = settle(anchors.join(of_anchor, "anchor_id").select("*", F.transform("p", lambda p: p["positive_score"]).alias("p_scores")))

    def best_negatives(key, a, t):
        out = ([], [], [], [])
        if a.num_rows and t.num_rows:
            ids, label, planes = by_label(t)
            for anchor, own, v, wanted in zip(a["anchor_id"].to_pylist(), a["a_label"].to_pylist(), matrix(a["a_whole"], np.int64, dim).astype(kind),
                                              a["p_scores"].to_pylist()):
                score = scores(subset_sums(v), planes)
                other = (label != own) & (ids != anchor)
                for rank, p in enumerate(wanted, 1):
                    least, most = -(-low * p // 100), high * p // 100  # of whole scores
                    at = first_of(score, ids, np.flatnonzero(other & (score >= least) & (score <= most)), negatives)
                    for column, values in zip(out, ([anchor] * len(at), [rank] * len(at), ids[at].tolist(), score[at].tolist())):
                        column.extend(values)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("anchor_id", "positive_rank", "negative_id", "negative_score"), out)})

    hard = dealt(asking.select("anchor_id", "a_whole", "a_label", "p_scores")).cogroup(candidates).applyInArrow(
        best_negatives, "anchor_id long, positive_rank long, negative_id long, negative_score long")
    order = "row_number() OVER (PARTITION BY anchor_id, positive_rank ORDER BY negative_score DESC, negative_id)"
    hard = hard.withColumn("rank", F.expr(order)).where(F.col("rank") <= negatives)
    named = asking.select("anchor_id", F.explode("p").alias("p")).select("anchor_id", "p.*").withColumn("positive_rank", F.col("positive_rank").cast("long"))
    return hard.join(named, ["anchor_id", "positive_rank"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank")


def op12(spark, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", "embedding", shifted.alias("label")))
