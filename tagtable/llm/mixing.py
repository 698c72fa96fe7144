"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Sources in code point order (a null source last) weigh 5, 2, 1, repeating, and share the words of all documents by
weight. No target passes ``MAX_COPIES`` times its source's words; what is over is shared again by weight among the rest.

Within a source each document is expected target / source words times. These expected copies are prefix-summed in order
of size, one random offset is added, and the document is taken once for each whole number its part of the sum
crosses. Neighbours in that order have like sizes, and every other stretch of them is turned round, so the words taken come near
the target. No document is taken more than three times.

The prefix sum is a rank times a constant. Ranks come from three small steps: documents counted by (source, size), by
(source, size, hash range) and row numbers inside a hash range; a source with a third of all rows, or a size shared by
all of them, is spread over the hash ranges. The offset is a hash of the seed and the source, so reruns agree.

Words are runs of bytes other than white space; a null or empty text has size 0. A source without words has target 0
and its documents are not taken. Rows repeated in full are separate documents that trade places freely. A null doc_id
ranks first among equals. An empty table gives an empty mix. Other columns are kept where the caller asks for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagtable.llm.common import read_table, settle

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = "mix"
RANGE_ROWS = 2_000  # rows a hash range is planned for


def word_count(text: Column) -> Column:
    """Number of runs of non-space characters."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def hash32(x: Column) -> Column:
    """The first 32 bits of the MD5 of a string."""
    return F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("long")


def source_key(source: Column) -> Column:
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("null"))


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """(source, source_size) -> source, source_size, weight, target. One row per source; runs on that small table.

    In order of limit / weight the sources at their limit come first; a source is at its limit when what remains for it
    and those after it, shared by weight, would pass it."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    big = "decimal(38,0)"
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("weight", w)
    by_limit = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    total = F.sum("source_size").over(Window.partitionBy())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("left_words", total - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(most))
         .withColumn("left_weight", F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing))))
    s = s.withColumn("open", (F.col("source_size") * F.lit(most)).cast(big) * F.col("left_weight") >= F.col("left_words").cast(big) * F.col("weight"))
    share = F.min(F.when(F.col("open"), F.struct(F.col("source_size") / F.col("weight"), (F.col("left_words").cast("double") / F.col("left_weight").cast("double")).alias("share")))
                  ).over(Window.partitionBy())["share"]
    level = F.when(F.col("open"), share * F.col("weight")).otherwise((F.col("source_size") * F.lit(most)).cast("double"))
    return s.select(*sizes.columns, "weight", level.alias("target"))


def turned(rank: Column, rate: Column, n: Column) -> Column:
    """The place of the document with this rank by size. A stretch of ranks whose fractional expected copies make one
    copy is taken forwards and the next one backwards (balanced systematic sampling): where the offset picks the
    larger documents of one stretch, it picks the smaller ones of the next."""
    part = rate - F.floor(rate)
    stretch = F.floor((rank - 1) * part)
    first, last = F.ceil(stretch / part) + 1, F.least(F.ceil((stretch + 1) / part), n)
    return F.when((part > 0) & (stretch % 2 == 1), first + last - rank).otherwise(rank)


def copies(docs: DataFrame, weights=WEIGHTS, most: int = MAX_COPIES, seed: str = SEED) -> DataFrame:
    """The documents with size, source_size, target and copies."""
    names = {c: f"own_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "source")}
    d = docs.select("doc_id", "text", "source", *[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    d = d.withColumn("size", word_count(F.col("text"))).withColumn("place", hash32(ident))
    ranges = max(1, -(-docs.count() // RANGE_ROWS))
    d = d.withColumn("hash_range", F.floor(F.col("place") * F.lit(ranges) / F.lit(2**32)))

    d = d.withColumn("source_key", source_key(F.col("source")))
    parts = settle(d.groupBy("source", "source_key", "size", "hash_range").agg(F.count("*").alias("n")))
    sources = parts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("source_docs"))
    goals = targets(sources, weights, most)
    parts = parts.drop("source")
    levels = parts.groupBy("source_key", "size").agg(F.sum("n").alias("n"))
    above = Window.partitionBy("source_key").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    levels = levels.select("source_key", "size", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("larger"))
    beside = Window.partitionBy("source_key", "size").orderBy("hash_range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("beside", F.coalesce(F.sum("n").over(beside), F.lit(0)))
    goals = goals.select(source_key(F.col("source")).alias("source_key"), "source_size", "source_docs", "target")
    plan = (parts.join(levels, ["source_key", "size"]).join(goals, "source_key")
            .select("source_key", "size", "hash_range", (F.col("larger") + F.col("beside")).alias("base"), "source_size", "source_docs", "target"))
    inside = Window.partitionBy("source_key", "size", "hash_range").orderBy("place", "doc_id")
    d = d.withColumn("row", F.row_number().over(inside)).join(plan, ["source_key", "size", "hash_range"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = hash32(F.concat(F.lit(seed + ":"), F.coalesce("source", F.lit("")))) / F.lit(float(2**32))
    rank = turned(F.col("base") + F.col("row"), rate, F.col("source_docs"))
    crossed = F.floor(rank * rate + offset) - F.floor((rank - 1) * rate + offset)
    keep = [F.col(names.get(c, c)).alias(c) for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    return d.select(*keep, "size", "source_size", "target", crossed.cast("long").alias("copies"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``docs``."""
    names = docs.columns
    plain = docs.select([F.col(f"`{c}`").alias(c if c in ("doc_id", "text", "source") else f"keep_{i}") for i, c in enumerate(names)])
    taken = copies(plain).where("copies > 0").withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return taken.select([F.col(c if c in ("doc_id", "text", "source") else f"keep_{i}").alias(c) for i, c in enumerate(names)])


def op3(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return copies(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")
