"""Skew-safe positions and running maxima against brute force; split
invariance under repartitioning; distribution sums."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from tagtable.operators.datasets import assign_subset, distribution
from tagtable.operators.positions import positions, prefix_max


def _skewed(spark, n=3000):
    # key 0 holds a third of all rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 17).alias("k"),
        (F.col("id") * 7 + 3).alias("o"), ((F.col("id") * 37) % 101).cast("double").alias("v"))


def test_positions_match_row_number(spark):
    df = _skewed(spark)
    for parts in (1, 7):
        got = positions(df.repartition(parts), "o", by=["k"], chunk_width=50)
        exp = df.withColumn("position", F.row_number().over(Window.partitionBy("k").orderBy("o")))
        assert got.select("k", "o", "position").exceptAll(exp.select("k", "o", "position")).count() == 0
        assert got.count() == df.count()


def test_global_positions(spark):
    df = _skewed(spark)
    got = {r.o: r.position for r in positions(df, "o").collect()}
    assert sorted(got.values()) == list(range(1, df.count() + 1))
    assert got[3] == 1


def test_prefix_max_matches_window(spark):
    df = _skewed(spark)
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    exp = df.withColumn("m", F.max("v").over(w))
    got = prefix_max(df, "v", "o", by=["k"], out="m", inclusive=False, chunk_width=40)
    assert got.select("k", "o", "m").exceptAll(exp.select("k", "o", "m")).count() == 0


def test_split_is_partition_independent(spark):
    df = spark.range(5000).withColumnRenamed("id", "key")
    a = assign_subset(df.repartition(1), "key").select("key", "subset")
    b = assign_subset(df.repartition(64), "key").select("key", "subset")
    assert a.exceptAll(b).count() == 0
    shares = {r.subset: r["count"] / 5000 for r in a.groupBy("subset").count().collect()}
    assert abs(shares["train"] - 0.64) < 0.03 and abs(shares["test"] - 0.2) < 0.03


def test_distribution_sums(spark):
    df = spark.createDataFrame([("train", [0, 1, 1]), ("train", []), ("test", [13])], "subset string, ner_tags array<bigint>")
    rows = {r.Subset: r for r in distribution(df).collect()}
    assert rows["train"].Num_of_Rows == 2 and rows["train"].Num_of_Tokens == 3
    assert rows["train"]["B-Person"] == 2 and rows["test"]["I-Percentage"] == 1 and rows["test"]["0"] == 0
    assert abs(rows["train"].Split - 2 / 3) < 1e-6


def test_positions_keep_null_keys_and_ties(spark):
    rows = [(None, 1, "a"), (None, 2, "b"), (1, 5, "c"), (1, 5, "d"), (1, None, "e"), (1, 4, "f"), (None, None, "g")]
    df = spark.createDataFrame(rows, "k int, o long, v string")
    got = positions(df, "o", by=["k"]).collect()
    assert len(got) == len(rows)
    assert sorted(r.position for r in got if r.k is None) == [1, 2, 3] and sorted(r.position for r in got if r.k == 1) == [1, 2, 3, 4]
    by = {r.v: r.position for r in got}
    assert (by["a"], by["b"], by["g"], by["f"], by["e"]) == (1, 2, 3, 1, 4) and {by["c"], by["d"]} == {2, 3}
    assert by == {r.v: r.position for r in positions(df.repartition(5), "o", by=["k"]).collect()}
    m = {r.v: r.running_max for r in prefix_max(df.withColumn("x", F.length("v") + F.coalesce("o", F.lit(9))), "x", "o", by=["k"]).collect()}
    assert len(m) == 7 and m["a"] == 2 and m["b"] == 3 and m["e"] == 10


def test_positions_of_sparse_ids(spark):
    """Hashed ids: the offset table stays at one row per chunk, not one per row."""
    from tagtable.operators import positions as P

    df = spark.range(20000).select(F.xxhash64("id").alias("o"))
    d = P.chunked(df, "o")
    assert d.select("_chunk").distinct().count() <= P.CHUNKS
    assert d.groupBy("_chunk").count().agg(F.max("count")).first()[0] < 200
    got = positions(df, "o")
    exp = df.withColumn("position", F.row_number().over(Window.orderBy("o")))
    assert got.select("o", "position").exceptAll(exp.select("o", "position")).count() == 0 and got.count() == 20000


def test_distribution_shuffles_no_token_arrays(spark):
    """Copies meet under a digest: no exchange carries the tokens, and each table is read once."""
    import re

    from tagtable.plans.queries import distribution_query

    plan = distribution_query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert keys and not any("tokens" in k or "ner_tags" in k for k in keys)
    assert len(re.findall(r"FileScan parquet", plan)) == 2


def test_corrections_need_one_grouping(spark):
    import re

    from tagtable.operators.corrections import apply_corrections

    a = spark.createDataFrame([(1, [0, 0])], "id long, fixed_tags array<int>")
    c = spark.createDataFrame([(1, 0, 3, 1, "ok")], "id long, token_index int, new_tag int, seq long, status string")
    plan = apply_corrections(a, c)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"ObjectHashAggregate|SortAggregate|HashAggregate", plan)) <= 2


def test_dedup_by_digest_equals_dedup(spark):
    from tagtable.operators.datasets import dedup, dedup_by_digest

    rows = [(i, ["a", "b"][: i % 3], [i % 2] * (i % 3)) for i in range(40)] + [(99, None, None), (98, None, None), (97, [None], [0])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>, ner_tags array<int>")
    a = sorted(r.id for r in dedup(df, ["tokens", "ner_tags"], keep="id").collect())
    assert a == sorted(r.id for r in dedup_by_digest(df, ["tokens", "ner_tags"], "id").collect())
