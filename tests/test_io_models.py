"""Sources/sinks and fitted-model round trips."""
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tagtable.operators import tagger as T
from tagtable.sources.tables import read_history_json, read_sentences_csv, write_table


def test_csv_and_partitioned_parquet_round_trip(spark):
    d = tempfile.mkdtemp(prefix="io-")
    src = os.path.join(d, "raw.csv")
    with open(src, "w", encoding="utf-8") as f:
        f.write('id,text,lemma_text\n1,"V roku 2020, ""NBS""","v rok 2020 NBS"\n2,"riadok\ndva","x"\n')
    df = read_sentences_csv(spark, src)
    rows = {r.id: r.text for r in df.collect()}
    assert rows == {1: 'V roku 2020, "NBS"', 2: "riadok\ndva"}
    out = df.withColumn("model", F.lit("m")).withColumn("run_id", F.lit("r1")).withColumn("tags", F.array(F.lit(0)))
    write_table(out, os.path.join(d, "pq"), partition_by=["model", "run_id"])
    assert os.path.isdir(os.path.join(d, "pq", "model=m", "run_id=r1"))
    write_table(out, os.path.join(d, "csv"), fmt="csv")
    back = (spark.read.option("header", "true").option("multiLine", "true").option("escape", "\"")
            .csv(os.path.join(d, "csv")))
    assert sorted(r.tags for r in back.collect()) == ["[0]", "[0]"]


def test_history_json_reader(spark):
    d = tempfile.mkdtemp(prefix="hist-")
    for run in ("a", "b"):
        with open(os.path.join(d, f"{run}.json"), "w") as f:
            json.dump({"log_history": [{"loss": 0.6, "epoch": 1, "step": 70},
                                       {"eval_loss": 0.2, "eval_f1": 0.71, "epoch": 1, "step": 70},
                                       {"train_loss": 0.1, "epoch": 2, "step": 140}]}, f)
    h = read_history_json(spark, d)
    assert h.count() == 6 and h.select("run_id").distinct().count() == 2
    assert sorted(r.position for r in h.filter(F.col("run_id").endswith("a.json")).collect()) == [1, 2, 3]


def test_sweep_and_model_round_trip(spark):
    rows = spark.createDataFrame(
        [(i, ["V", "roku", str(1990 + i % 9), "NBS"], [0, 0, 7, 3]) for i in range(60)],
        "id long, tokens array<string>, ner_tags array<int>")
    tr = T.token_rows(rows)
    best = T.sweep(tr, {"regParam": [0.0, 0.1]}, parallelism=2)
    assert len(best.validationMetrics) == 2
    model = T.fit_logreg(tr, max_iter=5, num_features=1 << 10)
    d = tempfile.mkdtemp(prefix="model-")
    T.save_model(model, os.path.join(d, "lr"))
    again = T.load_model(spark, os.path.join(d, "lr"))
    a = T.predict_logreg(model, tr).select("id", "idx", "pred")
    b = T.predict_logreg(again, tr).select("id", "idx", "pred")
    assert a.exceptAll(b).count() == 0
    maj = T.fit_majority(tr)
    T.save_model(maj, os.path.join(d, "maj"))
    assert T.load_model(spark, os.path.join(d, "maj"), majority=True).count() == maj.count()


def test_run_table_csv_reader(spark):
    from tagtable.operators import runs as R
    from tagtable.sources.tables import read_run_table

    d = tempfile.mkdtemp(prefix="runs-")
    with open(os.path.join(d, "runs.csv"), "w") as f:
        f.write('"Name","test/f1","note","test/recall"\n"m.2","0.5","x","0.25"\n"m.10","0.75","3",""\n')
    df = read_run_table(spark, d)
    assert dict(df.dtypes) == {"Name": "string", "test/f1": "double", "note": "string", "test/recall": "double"}
    assert [r.Name for r in R.sort_runs(df, ["test/f1"]).collect()] == ["m.10", "m.2"]


def test_split_reader_with_label_map(spark):
    from tagtable.sources.tables import read_splits

    d = tempfile.mkdtemp(prefix="splits-")
    for i, s in enumerate(("train", "validation", "test")):
        spark.createDataFrame([(["a", "b"], [i, 5])], "tokens array<string>, ner_tags array<int>").write.parquet(os.path.join(d, s))
    paths = {s: os.path.join(d, s) for s in ("train", "validation", "test")}
    assert {r.subset: r.ner_tags for r in read_splits(spark, paths).collect()} == {"train": [0, 5], "validation": [1, 5], "test": [2, 5]}
    assert {r.subset: r.ner_tags for r in read_splits(spark, paths, {0: 7, 5: 1}).collect()} == {"train": [7, 1], "validation": [1, 1], "test": [2, 1]}


def test_metrics_rows_are_put_by_name(spark):
    from tagtable.operators import metrics as M
    from tagtable.sources.outputs import put_metrics, read_metrics

    path = os.path.join(tempfile.mkdtemp(prefix="metrics-"), "t")
    df = spark.createDataFrame([([0, 1], [0, 1])], "g array<int>, p array<int>")
    row = M.token_metrics(M.confusion(M.gold_pred_pairs(df, "g", "p")))
    for name in ("first", "second", "first", "007"):
        put_metrics(row, path, name)
    back = read_metrics(spark, path)
    assert sorted(r.Name for r in back.collect()) == ["007", "first", "second"] and back.columns[0] == "Name"


def test_runs_can_be_written_again(spark, tmp_path):
    from tagtable.sources import outputs as O

    path = str(tmp_path / "t")
    rows = lambda n, k=0: spark.range(n).select("id", (F.col("id") + k).alias("v"))
    O.write_run(rows(5), path, "a/b=c")
    O.write_run(rows(3), path, "2")
    once = sorted(map(tuple, O.read_runs(spark, path).select("run", "id", "v").collect()))
    for _ in range(2):
        O.write_run(rows(5), path, "a/b=c")
    assert sorted(map(tuple, O.read_runs(spark, path).select("run", "id", "v").collect())) == once and len(once) == 8
    # a job that ends between the rows and the manifest: the run shows as incomplete, and writing it again mends it
    O._replace(rows(4, 9), path, "2")
    assert [r.run for r in O.incomplete_runs(spark, path).collect()] == ["2"]
    O._replace(rows(4), path, "new")
    assert sorted(r.run for r in O.incomplete_runs(spark, path).collect()) == ["2", "new"]
    assert O.read_runs(spark, path).filter("run = 'new'").count() == 0
    O.write_run(rows(3), path, "2")
    O.write_run(rows(4), path, "new")
    assert O.incomplete_runs(spark, path).count() == 0 and O.read_runs(spark, path).count() == 12
    # a run that ends with no rows hides what it wrote before; a failing one leaves the old rows
    O.write_run(rows(0), path, "new")
    assert sorted(map(tuple, O.read_runs(spark, path).select("run", "id", "v").collect())) == once
    with pytest.raises(Exception):
        O.write_run(rows(5).select("id", F.raise_error(F.lit("lost")).cast("long").alias("v")), path, "2")
    assert sorted(map(tuple, O.read_runs(spark, path).select("run", "id", "v").collect())) == once


def test_multi_line_csv_is_read_by_several_tasks(spark, tmp_path):
    import csv
    import random

    from tagtable.sources.lines import csv_records, split_corrupt

    rng = random.Random(5)
    cell = lambda: "".join(rng.choice(["a", ",", '"', "\n", "\\", " ", "é", "\n\n"]) for _ in range(rng.randrange(12)))
    want = [(i, cell() or "x", "z" + cell()) for i in range(400)]
    for end in ("\n", "\r\n"):
        path = tmp_path / f"f{len(end)}.csv"
        with open(path, "w", newline="") as f:
            w = csv.writer(f, quoting=csv.QUOTE_ALL, lineterminator=end)
            w.writerow(["id", "a", "b"])
            w.writerows((f"no{i}" if i % 50 == 3 else i, a, b) for i, a, b in want)
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
        try:
            good, bad = split_corrupt(csv_records(spark, str(path), "id bigint, a string, b string"))
            got = sorted(map(tuple, good.collect()))
            assert bad.count() == 8
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert got == [r for r in want if r[0] % 50 != 3]


@pytest.mark.parametrize("n", [0, 1, 40, 60, 99])
def test_first_rows_without_sorting(spark, n):
    from tagtable.sources.tables import first_rows

    df = spark.createDataFrame([(i * 7 - 50 if i % 4 else None, i) for i in range(60)], "id long, v int").repartition(4)
    want = sorted((r.id for r in df.collect()), key=lambda x: (x is None, x or 0))[:n]
    assert sorted((r.id for r in first_rows(df, n).collect()), key=lambda x: (x is None, x or 0)) == want
    names = df.withColumn("id", F.col("id").cast("string"))
    assert first_rows(names, n).count() == min(n, 60)


def test_saved_test_split_reads_back(spark):
    from tagtable.functions.tokens import parse_int_repr, repr_tokens_to_sentence
    from tagtable.plans.pipelines import test_split_repr as split_repr

    df = spark.createDataFrame([(1, ["a", "b"], [0, 3]), (2, [], [])], "id long, tokens array<string>, ner_tags array<int>")
    path = os.path.join(tempfile.mkdtemp(prefix="split-"), "t")
    write_table(split_repr(df).select("id", "tokens_repr", "ner_tags_repr"), path, fmt="csv")
    back = spark.read.option("header", "true").csv(path)
    got = {r.id: (r.s, r.t) for r in back.select("id", repr_tokens_to_sentence("tokens_repr").alias("s"), parse_int_repr("ner_tags_repr").alias("t")).collect()}
    assert got == {"1": ("a b", [0, 3]), "2": ("", [])}


def test_sweep_trials_are_run_table_rows(spark):
    rows = [(i, k, w, "<s>", "</s>", t) for i in range(60) for k, (w, t) in enumerate([("Eva", 1), ("ma", 0), ("NBS", 3)])]
    train = spark.createDataFrame(rows, "id long, idx int, token string, prev_token string, next_token string, tag int")
    values = T.random_values(2, 1e-4, 1e-1, seed=7)
    assert values == T.random_values(2, 1e-4, 1e-1, seed=7) and all(1e-4 <= v <= 1e-1 for v in values)
    got = T.sweep_trials(train, {"regParam": values}, repeats=2, num_features=64, max_iter=3).collect()
    assert [(r.repeat, r.trial) for r in got] == [(0, 0), (0, 1), (1, 0), (1, 1)] and {r.regParam for r in got} == set(values)
    assert all(0 <= r.f1 <= 1 for r in got) and sum(r.best for r in got) >= 2
