"""Range join, hard negatives and Merkle manifest against brute force."""
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagtable.llm import components, hard_negatives, merkle_manifest, metric_range_join


def finite(e, dim=16):
    return e is not None and len(e) == dim and all(v is not None and math.isfinite(v) for v in e)


# ---- range join

def join_by_force(rows, t=0.9):
    """rows: (vec_id, embedding) -> sorted (vec_id, n_links, component_id, kept)."""
    part = [k for k, (i, e) in enumerate(rows) if i is not None and finite(e) and any(e)]
    x = np.array([rows[k][1] for k in part], np.float64)
    u = x / np.sqrt((x * x).sum(1, keepdims=True))
    hit = u @ u.T >= t
    np.fill_diagonal(hit, False)
    links = dict(zip(part, hit.sum(1).tolist()))
    least = {rows[k][0]: rows[k][0] for k in part}
    pairs = [(rows[part[a]][0], rows[part[b]][0]) for a, b in np.argwhere(hit)]
    while True:
        before = dict(least)
        for a, b in pairs:
            least[a] = min(least[a], least[b])
        if before == least:
            break
    return sorted(((i, links.get(k, 0), least.get(i, i), i == least.get(i, i)) for k, (i, _) in enumerate(rows)), key=str)


def joined(df):
    return sorted((tuple(r) for r in metric_range_join.range_join(df).collect()), key=str)


def clustered(seed, centres, each, loose, dim=16):
    """Chains and groups about random centres at distances around the threshold, and a large group of near copies."""
    rng = np.random.default_rng(seed)
    x = [c + rng.normal(0, s, dim) for c in rng.normal(0, 1, (centres, dim)) for s in np.linspace(0.02, loose, each)]
    hub = rng.normal(0, 1, dim)
    x += [hub + rng.normal(0, 0.01, dim) for _ in range(len(x) // 2)]
    ids = rng.permutation(len(x)) * 3
    return [(int(i), [float(np.float32(v)) for v in e]) for i, e in zip(ids, x)]


def test_range_join_awkward_rows(vectors):
    rows = [tuple(r) for r in vectors.select("vec_id", "embedding").collect()]
    want = join_by_force(rows)
    assert any(n >= 30 for _, n, _, _ in want)
    assert joined(vectors) == want
    assert joined(vectors.withColumns({c: F.lit("extra") for c in ("uid", "name", "home", "own", "n_links", "kept", "label", "a", "b")})) == want


@pytest.mark.parametrize("slice_rows", [7, 16384])
def test_range_join_clusters_slices_and_cores(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(metric_range_join, "SLICE", slice_rows)
    rows = clustered(4, 12, 12, 0.45)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    want = join_by_force(rows)
    assert len({c for _, _, c, _ in want}) < len(rows) * 0.9 and max(n for _, n, _, _ in want) >= 70
    assert joined(df if slice_rows == 7 else df.withColumn("embedding", F.col("embedding").cast("array<double>"))) == want


def test_range_join_of_one_core(spark):
    """Rows that are all within half the radius of a pivot: counted, not compared."""
    rng = np.random.default_rng(5)
    centre = rng.normal(0, 1, 16)
    rows = [(i, (centre + rng.normal(0, 0.001, 16)).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert joined(df) == sorted(((i, 199, 0, i == 0) for i in range(200)), key=str)


def test_range_join_bounds_and_tiles():
    rng = np.random.default_rng(6)
    r = math.acos(0.9)
    u = metric_range_join.units(np.vstack([c + rng.normal(0, 0.08, (60, 8)) for c in rng.normal(0, 1, (6, 8))]))
    pivots = u[::50]
    far, home, own = metric_range_join._homes(u, pivots, r)
    low, high = np.full(2 * len(pivots), np.inf), np.full(2 * len(pivots), -np.inf)
    np.minimum.at(low, home, own)
    np.maximum.at(high, home, own)
    to = metric_range_join.visits(far, home, own, low, high, r)
    near = u @ u.T >= 0.9
    for a, b in np.argwhere(near):  # every linked pair of two homes meets exactly once
        if home[a] != home[b]:
            assert to[a, home[b]] + to[b, home[a]] >= 1
    assert to.mean() < 0.2  # and the bounds keep most apart
    counts, labels = metric_range_join.tile(u[:100], u[100:], 0.9)
    cross = near.copy()
    cross[:100, :100] = cross[100:, 100:] = False
    assert (counts == cross.sum(1)).all()
    assert all(labels[a] == labels[b] for a, b in np.argwhere(cross))


def test_range_join_very_large_and_small_components(spark):
    rows = [(1, [1e300] * 4), (2, [1e-300] * 4), (3, [1e300, -1e300, 1e300, -1e300]), (4, [1e300, 1e300, 1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert joined(df) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True)]


def test_components_hubs(spark):
    rng = random.Random(7)
    edges = [(0, i) for i in range(1, 900)] + [(rng.randrange(2000), rng.randrange(2000)) for _ in range(500)] + [(5000, None), (None, None), (7, 7)]
    label = list(range(2000))
    for _ in range(60):
        for a, b in edges:
            if a is not None and b is not None:
                label[a] = label[b] = min(label[a], label[b])
    used = {x for a, b in edges if a is not None and b is not None and a != b for x in (a, b)}
    got = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, got.collect())) == sorted((x, label[x]) for x in used)


# ---- hard negatives

def mined_by_force(rows, every=100, scale=256):
    rows = [(i, l, [math.floor(scale * v) for v in e]) for i, l, e in rows if i is not None and l is not None and finite(e)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    anchors = {}
    for i, l, e in rows:
        if i % every == 0:
            k = (np.array(e, np.int64).tobytes(), l, e)
            anchors[i] = min(anchors.get(i, k), k)
    out = []
    for i, (_, l, e) in anchors.items():
        scored = sorted((-dot(e, c), j, m) for j, m, c in rows if j != i)
        for rank, (p, j, _) in enumerate([s for s in scored if s[2] == l][:5], 1):
            hard = [(s, n) for s, n, m in scored if m != l and 30 * -p <= 100 * -s <= 90 * -p][:10]
            out += [(i, j, r, n, -p, -s, rank) for r, (s, n) in enumerate(hard, 1)]
    return sorted(out)


def labelled(seed, n=400, dim=16, scale=1.0):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(4) if i % 3 else 1, [rng.gauss(0, scale) for _ in range(dim)]) for i in range(n)]
    rows += [(n + i, i % 4, list(rows[20][2])) for i in range(12)]  # ties
    rows += [(700, None, [1.0] * dim), (701, 1, None), (702, 1, [None] + [1.0] * (dim - 1)), (703, 1, [math.nan] * dim), (704, 2, [0.0] * dim),
             (None, 1, [1.0] * dim), (705, 1, []), (706, 1, [1.0, 2.0]), (40, 2, [0.5] * dim), (800, 9, [1.0] * dim)]
    return rows


def mined(df, **options):
    return sorted(map(tuple, hard_negatives.mine(df, **options).collect()))


def test_hard_negatives(spark, monkeypatch):
    rows = labelled(8)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(3)
    want = mined_by_force(rows, 20)
    assert len(want) > 200
    assert mined(df, every=20) == want
    monkeypatch.setattr(hard_negatives, "SLICE", 50)
    monkeypatch.setattr(hard_negatives, "BLOCK", 4)
    clash = {c: F.lit("extra") for c in ("slice", "block", "planes", "whole", "largest", "score", "anchor_id", "rank", "p")}
    assert mined(df.withColumns(clash), every=20) == want


def test_hard_negatives_large_components_and_odd_dimensions(spark):
    rows = [(i, i % 3, [v * 10.0**6 for v in e[:5]]) for i, _, e in labelled(9, 120)[:120]]
    rows.append((121, 1, [1e30, 0.0, 0.0, 0.0, 0.0]))  # no score of it would fit: takes no part
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")

    assert mined(df, every=30) == mined_by_force([(i, l, e + [0.0] * 11) for i, l, e in rows[:-1]], 30)


def test_lookups_are_inner_products():
    rng = np.random.default_rng(10)
    for dim, top in ((1, 1), (7, 200), (64, 256), (9, 2**24)):
        v = rng.integers(-top, top, (50, dim))
        v[0], v[1] = -top, top - 1
        bits = 1 + int(np.ceil(np.log2(top)))
        planes = hard_negatives.bit_planes(v, bits)
        got = [hard_negatives.scores(hard_negatives.subset_sums(a), planes.transpose(1, 2, 0)) for a in v]
        assert (np.array(got) == v @ v.T).all()


# ---- manifest

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(hashes):
    """Root and, for each leaf, (place, siblings) by level."""
    steps, nodes = [[] for _ in hashes], [(h, [i]) for i, h in enumerate(hashes)]
    while len(nodes) > 1:
        runs = [nodes[a : a + 3] for a in range(0, len(nodes), 3)]
        for run in runs:
            for place, (_, below) in enumerate(run):
                for i in below:
                    steps[i].append((place, [h for k, (h, _) in enumerate(run) if k != place]))
        nodes = [(H(*[h for h, _ in run]), [i for _, below in run for i in below]) for run in runs]
    return nodes[0][0], steps


def manifest_by_force(rows, tamper):
    leaf = lambda r, text: H(*map(field, (r.doc_id, r.source, r.lang, r.n_chars, text)))
    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append(r)
    subroots, found = [], []
    for s in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        g = sorted(groups[s], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        hashes = [leaf(r, r.text) for r in g]
        root, steps = tree(hashes)
        subroots.append(root)
        found.append((g, hashes, steps))
    root, tops = tree(subroots)
    out = []
    for (g, hashes, steps), sub, top in zip(found, subroots, tops):
        for r, h, w in zip(g, hashes, steps):
            w, t = w + top, leaf(r, tamper(r))
            for place, others in w:
                t = H(*others[:place], t, *others[place:])
            out.append((r.doc_id, h, sub, root, H(*[x for _, others in w for x in others]), t, t == root))
    return sorted(out, key=str)


def without_breaks(r):
    even = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
    return r.text.replace("\n", "") if even and r.text is not None else r.text


def tiny(spark, n, sources):
    rows = [(i, f"line {i}\nend", "en", sources[i % len(sources)], i) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


class Tables:
    """Stands for a folder of tables."""

    def __init__(self, monkeypatch):
        self.docs = None
        monkeypatch.setattr(merkle_manifest, "read_table", lambda spark, sf_dir, name: self.docs)


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_manifest(spark, documents, clashing, monkeypatch, levels):
    monkeypatch.setattr(merkle_manifest, "LEVELS", levels)
    tables = Tables(monkeypatch)
    many = tiny(spark, 100, ["a", "b", "a", None, "ä", "a"])
    for docs in (documents, clashing, many) if levels == 8 else (documents, many):
        tables.docs = docs
        got = sorted(map(tuple, merkle_manifest.op13(spark, "").collect()), key=str)
        want = manifest_by_force(docs.select("doc_id", "text", "lang", "source", "n_chars").collect(), without_breaks)
        assert got == want
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28])
def test_frontier_is_the_tree(n):
    hashes = [H(str(i)) for i in range(n)]
    f, root = merkle_manifest.grow(hashes, 0)
    want, steps = tree(hashes)
    assert root == want and f.witness == steps


def test_open_subtrees_hold_partial_witnesses():
    """After each append a witness has the siblings that are complete, and no others."""
    f = merkle_manifest.Frontier()
    for i in range(27):
        f.append(H(str(i)))
        assert [len(w) for w in f.witness] == [sum((i + 1) // 3**k > j // 3**k for k in range(1, 4)) for j in range(i + 1)]
        assert sum(map(len, f.open)) <= 2 * len(f.open)  # what is kept open does not grow with the leaves


def test_lone_leaf_and_single_source(spark, monkeypatch):
    tables = Tables(monkeypatch)
    tables.docs = tiny(spark, 1, ["a"])
    r = merkle_manifest.op13(spark, "").first()
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == H() and r.verified == (r.folded_root == r.root)


def test_appended_leaves_give_the_tree_of_all(spark):
    docs = tiny(spark, 60, ["a", "b", None, "a"])
    first, later = docs.where("doc_id < 41"), docs.where("doc_id >= 41").unionByName(tiny(spark, 1, ["new"]).withColumn("doc_id", F.lit(99).cast("long")))
    both = merkle_manifest.extend(merkle_manifest.leaves(first), merkle_manifest.leaves(later))
    cols = ["doc_id", "rank", "hash", "subroot", "root", "witness"]
    got = merkle_manifest.manifest(both).select(cols).collect()
    assert sorted(map(str, got)) == sorted(map(str, merkle_manifest.manifest(merkle_manifest.leaves(first.union(later))).select(cols).collect()))


# ---- empty tables

def test_empty(spark, no_vectors, no_documents, monkeypatch):
    assert joined(no_vectors) == []
    assert mined(no_vectors.withColumn("label", F.lit(1))) == []
    tables = Tables(monkeypatch)
    tables.docs = no_documents
    assert merkle_manifest.op13(spark, "").collect() == []
