"""A Merkle manifest of a table of documents, with a witness (inclusion proof) for every row, built by appending.

Each row is a leaf: the hash H (hex sha256) of its fields, null apart from empty. The leaves of one source, by doc_id, are
the bottom of a tree whose every ``ARITY`` consecutive nodes become their H (the last run may be shorter, even one) while
more than one node remains; what remains is the source's subroot, and the subroots in order of source are the leaves of the
tree of the whole table.

A ``Frontier`` takes nodes one by one. It holds the open subtrees, each with the partial witnesses of the nodes below
it; as soon as the last sibling of a run is complete, the siblings' hashes extend every witness under them, and their H is
appended one level up. Appending is aligned: a frontier takes one block of ARITY ** LEVELS leaves, whose root does not
depend on other blocks, so blocks are built side by side and their roots are appended in turn to frontiers one
layer up, until each source has one. Then the witnesses that the upper layers gave a block's root extend those of the block's leaves.
``extend`` appends later rows to a manifest: numbers go on where a source ended, and the sealed blocks' leaves keep their places.

The place of a leaf in its source comes from a range partitioning of the leaves (ids and hashes, no texts) and the
counts of the partitions, so a source may hold any share of the rows. Only counts reach the driver.

Rows without a doc_id come first in their source, a null source before all others; rows equal in doc_id are ordered by leaf,
and equal leaves may stand in any order, since it changes nothing. Repeated rows are leaves of their own. Empty texts
and null ones have different leaves. Texts of any length are hashed whole. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagtable.llm.common import read_table, settle

ARITY, LEVELS = 3, 8
ROWS_PER_PART = 1_000_000
WITNESS = "array<struct<place: int, siblings: array<string>>>"


# ---- one block: streaming append

def node_hash(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


class Frontier:
    """Open subtrees of a tree under construction. ``open[k]`` holds the finished nodes of the current run of level k: the
    hash of each and the range of leaves below it. ``witness[i]`` has leaf i's (place, siblings), as far as known."""

    def __init__(self):
        self.open: list[list[tuple[str, int, int]]] = [[]]
        self.witness: list[list[tuple[int, list[str]]]] = []

    def append(self, leaf: str) -> None:
        n = len(self.witness)
        self.witness.append([])
        self._add(0, (leaf, n, n + 1))

    def _add(self, level: int, node: tuple[str, int, int]) -> None:
        run = self.open[level]
        run.append(node)
        if len(run) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        """Turn the open run into a node of the next level; each member's witnesses get the others' hashes."""
        run, self.open[level] = self.open[level], []
        hashes = [h for h, _, _ in run]
        for place, (_, a, b) in enumerate(run):
            step = (place, hashes[:place] + hashes[place + 1 :])
            for w in self.witness[a:b]:
                w.append(step)
        if level + 1 == len(self.open):
            self.open.append([])
        self._add(level + 1, (node_hash(hashes), run[0][1], run[-1][2]))

    def close(self, height: int | None = None) -> str:
        """The root: at ``height``, or as soon as a single node remains."""
        level = 0
        while level < len(self.open):
            rest = any(self.open[level + 1 :])
            if height is None and not rest and len(self.open[level]) == 1 or level == height:
                return self.open[level][0][0]
            if self.open[level]:
                self._complete(level)
            level += 1
        raise ValueError("no leaves")


def grow(leaves: list[str], block: int, levels: int = LEVELS) -> tuple[Frontier, str]:
    """Frontier and root of a block's leaves. Blocks after the first, and full ones, rise to the height of a block."""
    f = Frontier()
    for leaf in leaves:
        f.append(leaf)
    return f, f.close(levels if block or len(leaves) == ARITY**levels else None)


# ---- leaves and their places

def field(c: Column) -> Column:
    s = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_hash(text: Column) -> Column:
    """Leaf of a row with this text."""
    return F.sha2(F.concat(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text)), 256)


def source_key(source: Column) -> Column:
    """Sorts as the sources do, null first."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("s"), source))


def numbered(rows: DataFrame, by: str, order: list[Column]) -> DataFrame:
    """Adds rank, from 0, inside ``by``: a range partitioning, then each partition's rows behind those of earlier ones."""
    rows = settle(rows)
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // ROWS_PER_PART)
    keys = [F.col(by), *order, F.col("_uid")]  # the last splits equal rows
    placed = rows.withColumn("_uid", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id()  # number of the partition, then number in it
    placed = settle(placed.drop("_uid")).withColumn("_at", at).withColumn("_part", F.shiftright("_at", 33))
    earlier = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy(by, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    runs = runs.select(by, "_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return placed.join(runs, [by, "_part"]).withColumn("rank", F.expr("_before + _at - _first")).drop("_at", "_part", "_first", "_before")


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(key, doc_id, hash, tampered, rank): the leaves by source; ``tampered`` is a text whose leaf is kept beside."""
    other = leaf_hash(tampered) if tampered is not None else F.lit(None).cast("string")
    rows = docs.select(source_key(F.col("source")).alias("key"), "doc_id", leaf_hash(F.col("text")).alias("hash"), other.alias("tampered"))
    return numbered(rows, "key", [F.col("doc_id").asc_nulls_first(), F.col("hash"), F.col("tampered")])


def extend(old: DataFrame, more: DataFrame) -> DataFrame:
    """Leaves of a manifest with further ones (numbered among themselves) appended behind those of their source."""
    sizes = old.groupBy("key").agg(F.count("*").alias("_n"))
    # a row per source against all rows of it: split by place, so that no source's rows meet in one task
    salts = 64
    sizes = sizes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    later = more.withColumn("_salt", F.pmod("rank", F.lit(salts)).cast("int")).join(sizes, ["key", "_salt"], "left")
    later = later.withColumn("rank", F.col("rank") + F.coalesce("_n", F.lit(0)))
    return old.unionByName(later.select(*old.columns))


# ---- layers of blocks

def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("rank") / ARITY**LEVELS).cast("long"))


def _ordered(t: pa.Table) -> pa.Table:
    return t.take(pa.array(np.argsort(t["rank"].to_numpy(), kind="stable")))


def block_roots(nodes: DataFrame) -> DataFrame:
    """(key, rank, hash) -> (key, rank, hash) one layer up: the root of each block, at the block's number."""

    levels = LEVELS

    def run(key, t):
        k, block = key[0].as_py(), key[1].as_py()
        _, root = grow(_ordered(t)["hash"].to_pylist(), block, levels)
        return pa.table({"key": pa.array([k], pa.string()), "rank": pa.array([block], pa.int64()), "hash": pa.array([root], pa.string())})

    return _blocks(nodes.select("key", "rank", "hash")).groupBy("key", "block").applyInArrow(run, "key string, rank long, hash string")


def _witness_array(own: list[list[tuple[int, list[str]]]], upper: list[dict]) -> pa.Array:
    above = [(u["place"], u["siblings"]) for u in upper]
    steps = [s for w in own for s in (*w, *above)]
    counts = np.cumsum([0] + [len(w) + len(above) for w in own], dtype=np.int32)
    inner = np.cumsum([0] + [len(s) for _, s in steps], dtype=np.int32)
    siblings = pa.ListArray.from_arrays(pa.array(inner), pa.array([h for _, s in steps for h in s], pa.string()))
    return pa.ListArray.from_arrays(pa.array(counts), pa.StructArray.from_arrays([pa.array([p for p, _ in steps], pa.int32()), siblings], ["place", "siblings"]))


def attach(nodes: DataFrame, upper: DataFrame) -> DataFrame:
    """Nodes with subroot, root and witness: those of ``upper`` (key, rank of the block, subroot, root, witness), the block's own before."""
    kept, levels = nodes.columns, LEVELS

    def run(key, t, u):
        t, top = _ordered(t), u.select(["subroot", "root", "witness"]).to_pylist()[0]
        f, _ = grow(t["hash"].to_pylist(), key[1].as_py(), levels)
        out = {c: t[c] for c in kept}
        out["subroot"], out["root"] = (pa.array([top[c]] * t.num_rows, pa.string()) for c in ("subroot", "root"))
        out["witness"] = _witness_array(f.witness, top["witness"])
        return pa.table(out)

    types = ", ".join(f"{c} {nodes.schema[c].dataType.simpleString()}" for c in kept)
    above = upper.select("key", F.col("rank").alias("block"), "subroot", "root", "witness")
    grouped = _blocks(nodes).groupBy("key", "block").cogroup(above.groupBy("key", "block"))
    return grouped.applyInArrow(run, f"{types}, subroot string, root string, witness {WITNESS}")


def layers(nodes: DataFrame) -> list[DataFrame]:
    """The nodes, then layer above layer of block roots up to the one with a single node a key."""
    out = [nodes]
    while not out or len(out) == 1 or (out[-1].agg(F.max("rank")).first()[0] or 0) > 0:
        out.append(settle(block_roots(out[-1])))
    return out


def manifest(rows: DataFrame) -> DataFrame:
    """Leaves (key, doc_id, hash, tampered, rank) -> the same with subroot, root and witness."""
    rows = settle(rows)
    trees = layers(rows)
    subroots = trees[-1].select(F.lit("").alias("key"), F.col("key").alias("source"), "hash")
    sources = settle(numbered(subroots, "key", [F.col("source")]))
    tops = layers(sources)
    none = F.expr(f"CAST(array() AS {WITNESS})")
    upper = tops[-1].select("key", "rank", F.lit("").alias("subroot"), F.col("hash").alias("root"), none.alias("witness"))
    for layer in reversed(tops[:-1]):
        upper = settle(attach(layer, upper))
    upper = upper.select(F.col("source").alias("key"), F.lit(0).cast("long").alias("rank"), F.col("hash").alias("subroot"), "root", "witness")
    for layer in reversed(trees[1:-1]):
        upper = settle(attach(layer, upper))
    return attach(rows, upper)


# ---- proofs

def proof(witness: Column) -> Column:
    """All siblings' hashes, level by level from the leaf, left to right, as one text."""
    return F.array_join(F.flatten(F.transform(witness, lambda w: w["siblings"])), "")


def fold(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and its witness give."""
    step = lambda h, w: F.sha2(F.concat(F.array_join(F.slice(w["siblings"], F.lit(1), w["place"]), ""), h,
                                        F.array_join(F.slice(w["siblings"], w["place"] + 1, F.lit(ARITY)), "")), 256)
    return F.aggregate(witness, leaf, step)


def op13(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = manifest(leaves(docs, changed)).withColumn("folded_root", fold(F.col("tampered"), F.col("witness")))
    return found.select("doc_id", F.col("hash").alias("leaf"), "subroot", "root", F.sha2(proof(F.col("witness")), 256).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
