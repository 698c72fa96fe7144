"""Token and entity metrics by hand; run-table rules."""
from pyspark.sql import functions as F

from tagtable.operators import metrics as M
from tagtable.operators import runs as R


def test_token_metrics_by_hand(spark):
    df = spark.createDataFrame([([0, 0, 1, 2], [0, 1, 1, 1])], "g array<int>, p array<int>")
    conf = M.confusion(M.gold_pred_pairs(df, "g", "p"))
    r = M.token_metrics(conf).first()
    # labels 0,1,2: P=(1, 1/3, 0) R=(1/2, 1, 0) support (2,1,1)
    assert r["test/accuracy"] == 0.5
    assert abs(r["test/macro_precision"] - round((1 + 1 / 3) / 3, 6)) < 1e-9
    assert abs(r["test/recall"] - 0.5) < 1e-9  # weighted recall = accuracy
    assert conf.agg(F.sum("n")).first()[0] == 4 and conf.count() == 196


def test_entity_chunks(spark):
    df = spark.createDataFrame([(["B-P", "I-P", "O", "B-L", "B-L", "I-X"],)], "l array<string>")
    ch = df.select(M.chunks("l").alias("c")).first().c
    assert [(c.type, c.start, c.end) for c in ch] == [("P", 0, 1), ("L", 3, 3), ("L", 4, 4), ("X", 5, 5)]
    m = M.entity_metrics(spark.createDataFrame([(["B-P", "I-P", "O"], ["B-P", "O", "O"])], "g array<string>, p array<string>"), "g", "p").first()
    assert (m.precision, m.recall, m.accuracy) == (0.0, 0.0, round(2 / 3, 6))


def test_history_pairs_and_early_stop(spark):
    rec = spark.createDataFrame(
        [(1, 1, 0.9, None, None, 1, 1), (1, 2, None, 0.5, 0.6, 1, 2), (1, 3, 0.4, None, None, 2, 3),
         (1, 4, None, 0.4, 0.5, 2, 4), (1, 5, 0.3, None, None, 3, 5), (1, 6, None, 0.3, 0.55, 3, 6),
         (1, 7, 0.1, None, None, 4, 7)],
        "run_id int, position int, loss double, eval_loss double, eval_f1 double, epoch int, step int")
    pairs = R.history_pairs(rec)
    got = sorted((r.epoch, r.loss, r.eval_f1) for r in pairs.collect())
    assert got == [(1, 0.9, 0.6), (2, 0.4, 0.5), (3, 0.3, 0.55)]  # odd tail dropped
    assert R.best_epoch(pairs).first().best_epoch == 1
    assert R.early_stop(pairs, patience=2).first().stop_epoch == 3
    assert R.early_stop(pairs, patience=3).first().stop_epoch is None


def test_names_and_matching(spark):
    names = ["SlovakBERT_NER_Model_V0.0.4.9", "SlovakBERT_NER_Model_V0.0.4.10", "SlovakBERT_NER_Model_V_POC.1",
             "SlovakBERT_NER_Model_V0.0.2.1"]
    runs = spark.createDataFrame([(n,) for n in names], "Name string")
    order = [r.Name for r in runs.orderBy(R.natural_key("Name")).collect()]
    assert order.index(names[0]) < order.index(names[1])
    pv = {r.Name: r.p for r in runs.select("Name", R.parent_version("Name").alias("p")).collect()}
    assert pv[names[2]] == "SlovakBERT_NER_Model_V_POC" and pv[names[0]] == "SlovakBERT_NER_Model_V0.0.4"
    nv = {r.family: r.next_version for r in R.next_version(runs).collect()}
    assert nv["SlovakBERT_NER_Model_V0.0.4"] == 11
    files = spark.createDataFrame([("test_SlovakBERT_NER_Model_V0.0.4.10.csv",), ("t_SlovakBERT_NER_Model_V0.0.2._x.csv",)], "file string")
    m = {r.Name: (r.file, r.matched_by) for r in R.match_models_to_files(runs, files).collect()}
    # brute force: contains, else contains name minus two characters
    for n in names:
        exact = [f for (f,) in files.collect() if n in f]
        trimmed = [f for (f,) in files.collect() if n[:-2] in f]
        want = max(exact) if exact else (max(trimmed) if trimmed else None)
        assert m[n][0] == want
    assert m[names[3]][1] == "trimmed"


def test_top_k_per_group_matches_brute_force(spark):
    df = spark.range(400).select((F.col("id") % 3).alias("g"), ((F.col("id") * 13) % 97).alias("v"), "id")
    got = R.top_k_per_group(df, "g", [F.col("v").asc(), F.col("id").asc()], 10, salt_buckets=5)
    rows = df.collect()
    for g in range(3):
        exp = sorted([(r.v, r.id) for r in rows if r.g == g])[:10]
        assert sorted((r.v, r.id) for r in got.filter(F.col("g") == g).collect()) == exp


def test_natural_key_of_long_digit_runs(spark):
    names = ["m.20230318144455", "m.20230318144459", "m.202303181444", "m.9", "m.10", "m.007"]
    df = spark.createDataFrame([(n,) for n in names], "Name string").withColumn("k", R.natural_key("Name"))
    assert df.select("k").distinct().count() == len(names)
    assert [r.Name for r in df.orderBy("k").collect()] == ["m.007", "m.9", "m.10", "m.202303181444", "m.20230318144455", "m.20230318144459"]
    big = spark.createDataFrame([("m.20230318144459",)], "Name string")
    assert R.next_version(big).first().next_version == 20230318144460


def test_matching_without_a_common_prefix(spark):
    models = ["Other_Model_1.1", "x", "ab", "Model_2"]
    files = ["test_Other_Model_1.1.csv", "zzMo.csv", "Model_.csv", "ab", "xx_ab"]
    got = {r.Name: r.file for r in R.match_models_to_files(spark.createDataFrame([(m,) for m in models], "Name string"),
                                                           spark.createDataFrame([(f,) for f in files], "file string")).collect()}
    for m in models:
        exact = [f for f in files if m in f]
        cut = [f for f in files if len(m) > 2 and m[:-2] in f]
        assert got[m] == (max(exact) if exact else max(cut) if cut else None)


def test_version_folder(spark):
    v = spark.createDataFrame([("1.0",), ("2.0",), ("9",)], "version string")
    f = spark.createDataFrame([("m_1.0_b",), ("m_1.0_a",), ("2.0_x",), ("a_2.0",)], "folder string")
    assert {r.version: r.folder for r in R.pick_version_folder(v, f).collect()} == {"1.0": "m_1.0_a", "2.0": "2.0_x", "9": None}
    assert {r.version: r.folder for r in R.pick_version_folder(v, f, at_start=True).collect()} == {"1.0": None, "2.0": "2.0_x", "9": None}


def test_grid_of_more_values_than_the_old_bound(spark):
    got = R.param_grid_from_values(spark.range(1200).select((F.col("id") / 10).alias("v")), "v", ["a", "b"])
    assert got.count() == 1200**2 and got.distinct().count() == 1200**2
    assert R.param_grid_from_values(spark.range(0).select(F.col("id").alias("v")), "v", ["a"]).count() == 0


def test_evaluation_checks(spark):
    df = spark.createDataFrame([([0, -100, 20], [0, 0, 0]), ([1, 2], [1]), ([3], [3])], "g array<int>, p array<int>")
    r = M.evaluation_checks(df, "g", "p").first()
    assert (r.n_rows, r.mismatched_rows, r.unpaired_tokens, r.unknown_tag_pairs, r.counted_pairs) == (3, 1, 1, 2, 3)
    assert set(M.evaluate_all(df.limit(1), "g", "p")) >= {"entity_metrics", "checks"}


def test_chunk_matching_and_offsets_are_linear(spark):
    """A row of 20,000 tokens takes seconds, not minutes."""
    import time

    from tagtable.operators.spans import token_offsets

    n = 20000
    df = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (i % 14).cast("int")).alias("g"),
                               F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.repeat(F.lit("w"), (i % 7 + 1).cast("int"))).alias("t"))
    t0 = time.time()
    assert M.entity_metrics(df, "g", "g", ids=True).first().f1 == 1.0
    offs = df.select(token_offsets("t").alias("o")).first().o
    at = 0
    for i, x in enumerate(offs):
        assert (x.start, x.end) == (at, at + i % 7 + 1)
        at += i % 7 + 2
    assert time.time() - t0 < 30
