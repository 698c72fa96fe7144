"""N-gram Jaccard self-join of documents, with Bayesian pruning of candidates.

Two documents are linked when the Jaccard similarity of their sets of word 5-grams is at least 0.8.

1. Documents with equal shingle sets form a class; only one member of a class goes on.
2. MinHash signatures (96 values) are cut into 32 bands of 3; classes that share a band are candidates (a pair at 0.8
   shares none with probability (1 - 0.8^3)^32 = 1e-10). A band with many members is cut into blocks, and each pair of
   blocks is compared by a group of its own.
3. Candidates are pruned as in BayesLSH: after every 16 values, a pair is dropped when the posterior probability
   (uniform prior) that its similarity reaches the threshold falls below 1e-9. The rest make candidate clusters.
4. Inside a cluster (large ones again in pairs of blocks) all pairs are pruned the same way and the survivors are
   verified exactly on the shingle sets. A task sends counts for each document and stars of its groups, never the pairs.
5. Verified links make the classes: doc_id, class_id (smallest doc_id of the connected group), n_links (other documents
   linked, copies included), n_copies (documents with the same shingle set, itself included).

Words are separated by white space and used as they are. A text of one to four words has one shingle, all its words. A
null, empty or blank text has no shingles: it has no links and is a group of its own. Rows repeated in full are copies
of each other. A null doc_id takes part; class_id is null only where all of a group are. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtable.llm.common import (GRAM_MIX, IS_SPACE, gram_hashes, mix, read_table, settle, slices, text_buffer, word_bounds,
                                 word_hashes)
from tagtable.llm.components import components

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS, STEP, TOLERANCE = 32, 3, 16, 1e-9
BLOCK = 256
GROUP_ROWS = 4000  # rows a group of bands or clusters is planned for

_rng = np.random.default_rng(7)
MULT = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLUS = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


def shingle_sets(texts, k: int = SHINGLE):
    """For slices of documents: (first document, offsets, sorted distinct shingle hashes of each document)."""
    data, off = text_buffer(texts)
    for i, j in slices(off):
        part, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
        starts, ends, first = word_bounds(part, o, IS_SPACE)
        words = word_hashes(part, starts, ends)
        count = np.diff(first)
        h = gram_hashes(words, k)
        doc = np.repeat(np.arange(j - i), count)[: len(h)]
        whole = np.arange(len(h)) + k <= first[doc + 1]
        h, doc = h[whole], doc[whole]
        few = np.flatnonzero((count > 0) & (count < k))
        if len(few):
            h = np.concatenate([h, [gram_hashes(words[first[d] : first[d + 1]], int(count[d]))[0] for d in few]]).astype(np.uint64)
            doc = np.concatenate([doc, few])
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        h, doc = h[new], doc[new]
        yield i, np.searchsorted(doc, np.arange(j - i + 1)), h


def digests(off: np.ndarray, h: np.ndarray) -> list:
    """128-bit hash of each set; null for an empty one."""
    out: list = [None] * (len(off) - 1)
    full = np.flatnonzero(np.diff(off))
    if len(full):
        a = np.add.reduceat(mix(h * GRAM_MIX), off[full])
        b = np.add.reduceat(mix(h ^ np.uint64(0x5851F42D4C957F2D)), off[full])
        for d, x, y in zip(full.tolist(), a.tolist(), b.tolist()):
            out[d] = f"{x:016x}{y:016x}"
    return out


def _signatures(batches):
    for batch in batches:
        digest, size, sig = [], [], []
        for _, off, h in shingle_sets(batch["text"]):
            full = np.flatnonzero(np.diff(off))
            m = np.zeros((len(off) - 1, BANDS * ROWS), np.uint32)
            if len(full):
                for k in range(BANDS * ROWS):
                    m[full, k] = np.minimum.reduceat(((h * MULT[k] + PLUS[k]) >> np.uint64(32)).astype(np.uint32), off[full])
            digest += digests(off, h)
            size += np.diff(off).tolist()
            sig += [x.tobytes() for x in m]
        yield pa.record_batch({"doc_id": batch["doc_id"], "row_key": batch["row_key"], "digest": pa.array(digest, pa.string()), "size": pa.array(size, pa.int64()), "sig": pa.array(sig, pa.binary())})


def _bands(batches):
    for batch in batches:
        sig = np.frombuffer(b"".join(batch["sig"].to_pylist()), np.uint32).reshape(-1, BANDS * ROWS).astype(np.uint64)
        h = np.zeros((len(sig), BANDS), np.uint64)
        for r in range(ROWS):
            h = h * GRAM_MIX + sig[:, r::ROWS]
        h = mix(h + np.arange(BANDS, dtype=np.uint64) * GRAM_MIX)
        rows = np.repeat(np.arange(len(sig)), BANDS)
        yield pa.record_batch({"band": pa.array(h.reshape(-1).view(np.int64)), "digest": batch["digest"].take(pa.array(rows))})


def least_matches() -> list[tuple[int, int]]:
    """After n values, the fewest equal ones with which the posterior P(J >= threshold) is at least the tolerance.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1); its upper tail is a binomial sum."""
    out = []
    for n in range(STEP, BANDS * ROWS + 1, STEP):
        total, m = 0.0, -1
        while total < TOLERANCE:
            m += 1
            total += math.comb(n + 1, m) * THRESHOLD**m * (1 - THRESHOLD) ** (n + 1 - m)
        out.append((n, m))
    return out


LEAST = least_matches()


def prune(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i of a, j of b) that survive every look at their signatures."""
    same = np.zeros(len(i), np.int32)
    at = 0
    for n, least in LEAST:
        same += (a[i, at:n] == b[j, at:n]).sum(1, dtype=np.int32)
        keep = same >= least
        i, j, same, at = i[keep], j[keep], same[keep], n
    return i, j


def stars(i: np.ndarray, j: np.ndarray, names: list[str]) -> list[tuple[str, str]]:
    """For each connected group of the pairs, an edge from every member to the one with the least name. The edges that
    different bands give for one group are then the same."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x, y in zip(i.tolist(), j.tolist()):
        p, q = root(x), root(y)
        if p != q:
            parent[p] = q
    least: dict[int, str] = {}
    for x in parent:
        least[root(x)] = min(least.get(root(x), names[x]), names[x])
    return [(names[x], least[root(x)]) for x in parent if names[x] != least[root(x)]]


def _groups(*keys: np.ndarray):
    """Row numbers of each distinct key."""
    order = np.lexsort(keys[::-1])
    change = np.zeros(len(order), bool)
    for k in keys:
        change[1:] |= k[order][1:] != k[order][:-1]
    yield from np.split(order, np.flatnonzero(change))


def _pairs(table_rows: np.ndarray, side: np.ndarray, bi: int, bj: int):
    """Row pairs of a block with itself, or of two blocks, in pieces of bounded size."""
    if bi == bj:
        n = len(table_rows)
        for a in range(0, n, BLOCK):
            x, y = np.meshgrid(np.arange(a, min(a + BLOCK, n)), np.arange(n), indexing="ij")
            keep = x < y
            yield table_rows[x[keep]], table_rows[y[keep]]
    else:
        left, right = table_rows[side == bi], table_rows[side == bj]
        for a in range(0, len(left), BLOCK):
            x, y = np.meshgrid(left[a : a + BLOCK], right, indexing="ij")
            yield x.reshape(-1), y.reshape(-1)


def _candidates(key, table):
    """The pairs of each band that survive, as stars."""
    names = table["digest"].to_pylist()
    band, bi, bj, side = (table[c].to_numpy() for c in ("band", "bi", "bj", "side"))
    sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint32).reshape(-1, BANDS * ROWS)
    edges = []
    for rows in _groups(band, bi, bj):
        if len(rows) < 2:
            continue
        left, right = [], []
        for x, y in _pairs(rows, side[rows], bi[rows[0]], bj[rows[0]]):
            x, y = prune(sig, sig, x, y)
            left.append(x)
            right.append(y)
        edges += stars(np.concatenate(left), np.concatenate(right), names)
    return pa.table({c: pa.array([e[k] for e in edges], pa.string()) for k, c in enumerate("ab")})


def blocked(members: DataFrame, key: str, sizes: DataFrame) -> DataFrame:
    """Members (key, ...) of groups with ``n`` members, once for each pair of blocks they take part in."""
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    return (members.join(sizes, key).withColumn("nb", blocks)
            .withColumn("side", F.pmod(F.xxhash64("digest"), F.col("nb")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
            .withColumn("bi", F.least("side", "other")).withColumn("bj", F.greatest("side", "other")).drop("other", "nb", "n"))


def grouped(df: DataFrame, key: str, total: int) -> DataFrame:
    n = max(1, -(-total // GROUP_ROWS))
    return df.withColumn("part", F.pmod(F.xxhash64(key, "bi", "bj"), F.lit(n)).cast("int")).groupBy("part")


def _set_rows(batches):
    """The shingle set of each class, from the row that stands for it."""
    for batch in batches:
        keep, sets, got = [], [], 0
        want = batch["digest"].to_pylist()
        for i, off, h in shingle_sets(batch["text"]):
            for d, x in enumerate(digests(off, h)):
                if x == want[i + d]:
                    keep.append(i + d)
                    sets.append(h[off[d] : off[d + 1]].tobytes())
        yield pa.record_batch({"digest": batch["digest"].take(pa.array(keep, pa.int64())), "shingles": pa.array(sets, pa.binary())})


def overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Size of the intersection of each pair of sets."""
    if len(i) <= 64:
        return np.array([np.count_nonzero(np.isin(sets[x], sets[y], assume_unique=True)) for x, y in zip(i, j)], np.int64)
    used = np.unique(np.concatenate([i, j]))
    words, code = np.unique(np.concatenate([sets[x] for x in used]), return_inverse=True)
    owner = np.repeat(np.arange(len(used)), [len(sets[x]) for x in used])
    total = np.zeros((len(used), len(used)), np.float32)
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    for a in range(0, len(words), 4096):  # matrix products over slices of the vocabulary
        s, e = np.searchsorted(code, (a, a + 4096))
        m = np.zeros((len(used), 4096), np.float32)
        m[owner[s:e], code[s:e] - a] = 1
        total += m @ m.T
    at = np.searchsorted(used, np.arange(len(sets)))
    return total[at[i], at[j]].astype(np.int64)


def _verify(key, table):
    label = table["label"].combine_chunks().dictionary_encode().indices.to_numpy()
    bi, bj, side, copies = (table[c].to_numpy() for c in ("bi", "bj", "side", "copies"))
    sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint32).reshape(-1, BANDS * ROWS)
    sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
    size = np.array([len(x) for x in sets], np.int64)
    names = table["digest"].to_pylist()
    links, edges = np.zeros(len(sets), np.int64), []
    for rows in _groups(label, bi, bj):
        left, right = [], []
        for x, y in _pairs(rows, side[rows], bi[rows[0]], bj[rows[0]]):
            x, y = prune(sig, sig, x, y)
            if len(x):
                both = overlaps(sets, x, y)
                yes = 5 * both >= 4 * (size[x] + size[y] - both)  # the threshold 0.8, in whole numbers
                left.append(x[yes])
                right.append(y[yes])
        if left:
            x, y = np.concatenate(left), np.concatenate(right)
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            edges += stars(x, y, names)
    linked = np.flatnonzero(links).tolist()
    return pa.table({"a": pa.array([*(names[x] for x in linked), *(e[0] for e in edges)], pa.string()),
                     "b": pa.array([None] * len(linked) + [e[1] for e in edges], pa.string()),
                     "links": pa.array([*links[linked].tolist(), *[None] * len(edges)], pa.int64())})


def linked_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, row_key, digest of the shingle set) and classes (digest, label of the group, copies, links)."""
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key"))
    sigs = settle(rows.mapInArrow(_signatures, "doc_id long, row_key long, digest string, size long, sig binary"))
    classes = (sigs.where("digest is not null").groupBy("digest")
               .agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"), F.first("sig").alias("sig")))
    classes = settle(classes)

    bands = classes.select("digest", "sig").mapInArrow(_bands, "band long, digest string")
    shared = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = settle(blocked(bands, "band", shared))
    edges = grouped(members.join(classes.select("digest", "sig"), "digest"), "band", members.count()).applyInArrow(_candidates, "a string, b string")
    clusters = components(edges)

    sizes = clusters.groupBy("label").agg(F.count("*").alias("n"))
    placed = clusters.select(F.col("node").alias("digest"), "label")
    chosen = classes.join(placed, "digest").select("digest", "first_doc")
    sets = (docs.select("doc_id", "text").join(chosen, F.col("doc_id").eqNullSafe(F.col("first_doc"))).select("digest", "text")
            .mapInArrow(_set_rows, "digest string, shingles binary").groupBy("digest").agg(F.first("shingles").alias("shingles")))
    blocks = settle(blocked(placed, "label", sizes))
    loaded = blocks.join(classes.select("digest", "copies", "sig"), "digest").join(sets, "digest")
    verified = settle(grouped(loaded, "label", blocks.count()).applyInArrow(_verify, "a string, b string, links long"))

    groups = components(verified.where("b is not null").select("a", "b"))
    links = verified.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    known = (classes.select("digest", "first_doc", "copies").join(groups.withColumnRenamed("node", "digest"), "digest", "left")
             .join(links.withColumnRenamed("a", "digest"), "digest", "left").withColumn("label", F.coalesce("label", "digest")))
    return sigs.select("doc_id", "row_key", "digest"), known.select("digest", "label", "first_doc", "copies", F.coalesce("links", F.lit(0)).alias("links"))


def jaccard_join(docs: DataFrame) -> DataFrame:
    rows, classes = linked_classes(docs)
    first = classes.groupBy("label").agg(F.min("first_doc").alias("class_id"))
    known = classes.join(first, "label").select("digest", "class_id", "copies", "links")
    out = rows.join(known, "digest", "left")
    return out.select("doc_id", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).alias("n_links"), F.coalesce("copies", F.lit(1)).alias("n_copies"))


def one_per_group(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest doc_id (nulls last); texts without words all stay. Of
    rows equal in doc_id and text the one that is least by its other columns (but maps and variants, which have no order)
    stays."""
    rows, classes = linked_classes(docs)
    group = F.coalesce("label", F.concat(F.lit("row "), F.col("row_key").cast("string")))
    chosen = (rows.join(classes.select("digest", "label"), "digest", "left").groupBy(group.alias("g"))
              .agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_key"))).alias("m")).select(F.col("m.row_key").alias("chosen_key")))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64("doc_id", "text").alias("chosen_key"))
    ordered = [f.name for f in docs.schema.fields if f.name not in ("doc_id", "text") and not re.search("map<|variant", f.dataType.simpleString())]
    place = F.struct(F.lit(0), *[F.col(f"row.`{c}`") for c in ordered])
    return keyed.join(chosen, "chosen_key").groupBy("chosen_key").agg(F.min_by("row", place).alias("row")).select("row.*")


def op2(spark, sf_dir: str) -> DataFrame:
    return jaccard_join(read_table(spark, sf_dir, "documents"))
