"""Vector searches against brute force."""
import math

import numpy as np
from pyspark.sql import functions as F

from tagtable.llm import permutation_index, voronoi_knn
from tagtable.llm.vectors import sample as vectors_sample


def good(rows, zero):
    return [(r.vec_id, r.embedding) for r in rows if r.vec_id is not None and r.embedding and len(r.embedding) == 16
            and all(v is not None and math.isfinite(v) for v in r.embedding) and (zero or any(r.embedding))]


def by_force(rows, every, k, score):
    out = {}
    for q in sorted({i for i, _ in rows if i % every == 0}):
        x = next(e for i, e in rows if i == q)
        out[q] = sorted((-score(x, e), i) for i, e in rows if i != q)[:k]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def test_voronoi_join(vectors, spark, monkeypatch):
    monkeypatch.setattr(voronoi_knn, "DATA_SLICE", 100)
    monkeypatch.setattr(voronoi_knn, "QUERY_BLOCK", 3)
    rows = good(vectors.collect(), True)
    whole = [(i, np.floor(1024 * np.array(e, np.float64)).astype(np.int64)) for i, e in rows]
    want = by_force(whole, 20, 10, lambda a, b: int(a @ b))
    for df in (vectors, vectors.withColumns({c: F.lit("extra") for c in ("cell", "far", "score", "rank", "query_id", "vec")})):
        assert answers(voronoi_knn.knn_join(df, every=20)) == want
    few = vectors.where("vec_id in (20, 400, 401)")
    assert answers(voronoi_knn.knn_join(few, every=20)) == by_force([r for r in whole if r[0] in (20, 400, 401)], 20, 10, lambda a, b: int(a @ b))


def test_voronoi_bounds_leave_data_out(spark):
    """Tight clusters far apart: each query cell gets its own cluster only, and the answer is still exact."""
    rng = np.random.default_rng(1)
    centre = np.eye(8)[:4] * 100
    rows = [(i, (centre[i % 4] + rng.normal(0, 0.01, 8)).tolist()) for i in range(800)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = answers(voronoi_knn.knn_join(df, every=50))
    stored = [(r.vec_id, np.floor(1024 * np.array(r.embedding, np.float64)).astype(np.int64)) for r in df.collect()]
    assert got == by_force(stored, 50, 10, lambda a, b: int(a @ b))


def test_voronoi_pivots_grow_with_the_queries(vectors, monkeypatch):
    assert [voronoi_knn.pivots_for(n) for n in (0, 512, 51_200, 10**9)] == [8, 8, 100, 512]
    asked = []
    monkeypatch.setattr(voronoi_knn, "QUERY_BLOCK", 2)
    monkeypatch.setattr(voronoi_knn, "sample", lambda rows, n: asked.append(n) or vectors_sample(rows, n))
    whole = [(i, np.floor(1024 * np.array(e, np.float64)).astype(np.int64)) for i, e in good(vectors.collect(), True)]
    assert answers(voronoi_knn.knn_join(vectors, every=10)) == by_force(whole, 10, 10, lambda a, b: int(a @ b))
    assert asked[0] > 8


def test_voronoi_repeated_query_ids(spark):
    """Rows of one query's vec_id fill a tight cluster: its neighbours lie in clusters far away and must still be found."""
    rng = np.random.default_rng(2)
    centre = np.eye(8)[:4] * 100
    near = lambda c: (centre[c] + rng.normal(0, 0.01, 8)).tolist()
    ids = [r[0] for r in spark.range(1, 701).orderBy(F.xxhash64("id")).collect()]  # the first ones become pivots
    q = [i for i in ids if i % 50 == 0][-1]
    rows = [(q, near(0))] * 6 + [(q, near(0)) for _ in range(6)] + [(i, near(0)) for i in ids[:3]]
    rows += [(i, near(1 + n % 3)) for n, i in enumerate(i for i in ids[3:604] if i != q)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    stored = [(r.vec_id, np.floor(1024 * np.array(r.embedding, np.float64)).astype(np.int64)) for r in df.collect()]
    stored.sort(key=lambda r: r[1].astype(np.float64).tobytes())  # of repeated ids the least row by its bytes is the query
    got = answers(voronoi_knn.knn_join(df, every=50))
    assert len(got[q]) == 10 and got == by_force(stored, 50, 10, lambda a, b: int(a @ b))


def test_permutation_index(vectors, monkeypatch):
    rows = good(vectors.collect(), False)

    def score(a, b):
        total = 0.0
        for x, y in zip(a, b):
            total += x * y
        return total

    want = by_force(rows, 20, 20, score)
    monkeypatch.setattr(permutation_index, "SHARD_ROWS", 200)
    for df in (vectors, vectors.withColumns({c: F.lit("extra") for c in ("shard", "pivots", "score", "rank", "query_id", "vec")})):
        got = answers(permutation_index.search(df))
        assert set(got) == set(want)
        exact = {(q, i): s for q, e in by_force(rows, 20, len(rows), score).items() for s, i in e}
        hits = 0
        for q, found in got.items():
            assert found == sorted(found) and all(abs(exact[q, i] - s) < 1e-12 for s, i in found)
            hits += len({i for _, i in found} & {i for _, i in want[q]})
        assert hits >= 0.9 * sum(map(len, want.values()))
    assert answers(permutation_index.search(vectors, share=1.0)) == want  # all are reranked: exact, ties included


def test_permutation_index_keeps_equal_vectors_together(spark):
    """More copies of a vector than are reranked: the copies with the smallest ids must be the answer."""
    rng = np.random.default_rng(3)
    rows = [(i, [10.0] * 16 if i % 2 == 0 else rng.normal(0, 1, 16).tolist()) for i in range(600)]
    got = answers(permutation_index.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), every=200))
    assert {q: [i for _, i in f] for q, f in got.items()} == {q: [i for i in range(0, 44, 2) if i != q][:20] for q in (0, 200, 400)}


def test_footrule_of_a_block_by_files():
    rng = np.random.default_rng(5)
    lists = permutation_index.ends(rng.normal(0, 1, (40, 20)), 6)
    files = permutation_index.inverted_files(lists, 40)
    got = permutation_index.nearness(permutation_index.inverted_files(lists[:7], 40), files, 7, 40)
    for q in range(7):
        for r in range(40):
            footrule = 0
            for side in (slice(0, 6), slice(6, 12)):
                a, b = lists[q, side].tolist(), lists[r, side].tolist()
                footrule += sum(abs((a.index(p) if p in a else 6) - (b.index(p) if p in b else 6)) for p in {*a, *b})
            assert footrule == 2 * (2 * sum(range(1, 7))) - 2 * got[q, r]


def test_recall_on_the_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = answers(permutation_index.search(df))
    e = df.toPandas()
    x, ids = np.array(e.embedding.tolist(), np.float64), e.vec_id.to_numpy()
    hits = 0
    for q in got:
        s = x @ x[np.flatnonzero(ids == q)[0]]
        s[ids == q] = -np.inf
        hits += len({i for _, i in got[q]} & set(ids[np.argsort(-s, kind="stable")[:20]].tolist()))
    assert hits >= 0.9 * 20 * len(got)


def test_empty_tables(no_vectors):
    assert voronoi_knn.knn_join(no_vectors).collect() == [] and permutation_index.search(no_vectors).collect() == []
