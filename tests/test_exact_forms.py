"""List texts, review files of any line end, histories with any keys, exact splits, chunks over sentence ends."""
import ast
import json
import math
import random
import warnings

import pytest
from pyspark.sql import functions as F

from tagtable.constants import LABELS
from tagtable.functions.tokens import parse_list, split_rejects
from tagtable.operators import corrections as C
from tagtable.operators import datasets as D
from tagtable.operators import metrics as M
from tagtable.operators import runs as R
from tagtable.sources import tables as S


# ---- C5

def read_by_python(text):
    """What Python reads, or None where that is no list of strings, or none that UTF-8 can hold."""
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            v = ast.literal_eval(text)
        return v if isinstance(v, list) and all(x is None or isinstance(x, str) and x.encode() is not None for x in v) else None
    except (ValueError, SyntaxError, UnicodeEncodeError):
        return None


def test_every_repr_of_strings_parses(spark):
    rng = random.Random(1)
    marks = ["a", "'", '"', "\\", "\n", "\r", "\t", "\x00", "\x07", "\x7f", "\xa0", "​", "ľ", "\U0001f600", "﻿", "", " ", ",", "[", "]", "None", "x41", "7"]
    lists = [["".join(rng.choice(marks) for _ in range(rng.randrange(8))) for _ in range(rng.randrange(5))] for _ in range(600)]
    lists += [[], [""], [None, "None"], ["x\n"] * 20_000, ["\\" * 50_000], ["'" * 9 + '"' * 9]]
    df = spark.createDataFrame([(i, repr(v)) for i, v in enumerate(lists)], "i int, t string")
    assert {r.i: r.v for r in df.select("i", parse_list("t").alias("v")).collect()} == dict(enumerate(lists))


def test_texts_read_as_python_reads_them(spark):
    rng = random.Random(2)
    marks = ["'", '"', "\\", "n", "x4", "x41", "u0", "u0041", "U0001f600", "U00110000", "N", "a", " ", ",", "[", "]", "\n", "\t", "None", "7", "101", "ud83d", "\\'"]
    texts = ["[" + q + "".join(rng.choice(marks) for _ in range(rng.randrange(9))) + q + "]" for _ in range(1000) for q in ("", "'", '"')]
    texts += ["", "[]", " []", "\n[]", "[] \n", "['a']]", "['a'", "'a'", "['a',]", "[,]", "['a',,'b']", "['a' 'b', \"c\"\n'd']", "['a\\\nb']", "['\\777']", "['\\0']", "('a',)", "[1]"]
    want = {t: read_by_python(t) for t in texts}
    got = {r.t: r.v for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_list("t").alias("v")).collect()}
    assert got == want and sum(v is not None for v in want.values()) > 100
    assert spark.range(1).select(parse_list(F.lit("['\\N{DASH}']")).alias("v")).first().v is None  # the one escape that is not read


def test_integer_lists_and_rejects(spark):
    df = spark.createDataFrame([("[0, -3, +4]",), ("[]",), ("[None, 00]",), ("[9223372036854775807]",), ("[9223372036854775808]",), ("[01]",), ("[1 2]",),
                                ("['1']",), ("[1.0]",), (None,)], "t string").withColumn("v", parse_list("t", "bigint"))
    good, bad = split_rejects(df, "t", "v")
    assert [r.v for r in good.collect()] == [[0, -3, 4], [], [None, 0], [9223372036854775807], None] and bad.count() == 5


# ---- S7

def block(i, token, label):
    return f"Row: {i}\nID: {i}\nToken Index: {token}\nWord: w\nNER Tag: 0 -- {label}"


@pytest.mark.parametrize("end", ["\n", "\r\n", "mixed"])
def test_review_file_is_read_by_several_tasks(spark, tmp_path, end):
    blocks = [block(i, i % 7, LABELS[i % 14]) for i in range(300)]
    ends = ["\n" if end == "mixed" and i % 2 else "\r\n" if end == "mixed" else end for i in range(300)]
    text = "".join((b + "\n\n" + "\n" * (i % 3)).replace("\n", e) for i, (b, e) in enumerate(zip(blocks, ends)))
    path = tmp_path / "answers.txt"
    path.write_bytes(("\n \n" + text).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # a split every 2000 bytes: many borders inside blocks
    try:
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 5
        got = C.read_correction_blocks(spark, str(path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.block for r in sorted(got, key=lambda r: r.seq)] == blocks


def test_blocks_of_several_files_follow_the_given_order(spark, tmp_path):
    for name, label in (("b", "B-Person"), ("a", "B-Date")):
        (tmp_path / name).write_bytes((block(1, 0, label) + "\n\n" + block(1, 0, label)).encode())
    parsed = C.parse_corrections(C.read_correction_blocks(spark, [str(tmp_path / "b"), str(tmp_path / "a")]))
    fixed = C.apply_corrections(spark.createDataFrame([(1, [0])], "id long, fixed_tags array<int>"), parsed).first().fixed_tags
    assert [LABELS[t] for t in fixed] == ["B-Date"]


# ---- W5, S5

def merged_by_python(log):
    kept = [r for r in log if "loss" in r or "eval_loss" in r]
    return [{**kept[i], **kept[i + 1]} for i in range(0, len(kept) - 1, 2)]


def test_histories_keep_keys_nobody_names(spark, tmp_path):
    rng = random.Random(3)
    logs = {}
    for f in range(4):
        log = [{"epoch": i // 2, **{k: rng.randrange(100) for k in ("loss", "eval_loss", "grad_norm", "extra", "learning_rate") if rng.random() < 0.6}}
               for i in range(rng.randrange(25))]
        log.append({"train_loss": 1, "total": 2})
        logs[f"run{f}.json"] = log
        (tmp_path / f"run{f}.json").write_text(json.dumps({"log_history": log, "best": None}, indent=1))
    want = {name: merged_by_python(log) for name, log in logs.items()}
    raw = S.read_history_logs(spark, str(tmp_path))
    ints = lambda m: {k: int(v) for k, v in m.items()}
    whole = {r.run_id.rsplit("/", 1)[1]: [ints(m) for m in r.m] for r in raw.select("run_id", R.merge_log("log").alias("m")).collect()}
    assert whole == want
    rows = raw.select("run_id", F.posexplode(F.filter("log", R.is_step_record)).alias("position", "record")).withColumn("position", F.col("position") + 1)
    S.write_history_lines(rows, str(tmp_path / "lines"))
    back = R.merge_history(S.read_history_lines(spark, str(tmp_path / "lines"))).collect()
    got = {}
    for r in sorted(back, key=lambda r: r.pair):
        got.setdefault(r.run_id.rsplit("/", 1)[1], []).append(ints(r.record))
    assert got == {k: v for k, v in want.items() if v}


def test_a_later_null_wins(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"}, {"a": None, "c": "3"})], "x map<string,string>, y map<string,string>")
    assert df.select(R.merge_records("x", "y").alias("m")).first().m == {"a": None, "b": "2", "c": "3"}


# ---- W6

@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 7, 11, 100, 333])
def test_exact_sizes(spark, n):
    df = spark.range(n).select(F.col("id").alias("key"), F.lit("x").alias("text"))
    sizes = {r.subset: r["count"] for r in D.assign_exact_subset(df, "key").groupBy("subset").count().collect()}
    both = math.floor(0.8 * n)
    want = {"train": math.floor(0.8 * both), "validation": math.ceil(0.2 * both), "test": math.ceil(0.2 * n)}
    assert sizes == {k: v for k, v in want.items() if v} and sum(want.values()) == n


def test_split_ties_and_partitions(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("key"), F.col("id").alias("other"))
    a = D.assign_exact_subset(df, "key")
    assert {r.subset: r["count"] for r in a.groupBy("subset").count().collect()} == {"train": 320, "validation": 80, "test": 100}
    b = D.assign_exact_subset(df.repartition(7), "key")
    assert a.exceptAll(b).count() == 0
    assert a.exceptAll(D.assign_exact_subset(df, "key", seed=43)).count() > 100


def test_smallest_cuts(spark):
    rng = random.Random(4)
    values = [rng.randrange(40) for _ in range(200)] + [2**59 + rng.randrange(5) for _ in range(50)] + [0] * 9
    df = spark.createDataFrame([(v,) for v in values], "v long")
    ks = [0, 1, 9, 10, 100, 200, 209, 230, 259, 300]
    for k, (t, m) in zip(ks, D.smallest(df, "v", ks)):
        below = [v for v in values if v < t]
        assert len(below) + m == min(k, len(values)) and m <= values.count(t)
        assert sorted(values)[: len(below)] == sorted(below)


# ---- A7

def end_of_chunk(prev, cur, prev_type, kind):
    return prev in "ES" or prev in "BI" and cur in "BSO" or prev not in "O." and prev_type != kind


def start_of_chunk(prev, cur, prev_type, kind):
    return cur in "BS" or prev in "ESO" and cur in "EI" or cur not in "O." and prev_type != kind


def chunks_by_scan(sentences):
    labels = [x for s in sentences for x in [LABELS[t] for t in s] + ["O"]]
    prev, prev_type, begin, out = "O", "", 0, []
    for i, label in enumerate(labels + ["O"]):
        cur, kind = label[0], label[1:].split("-", 1)[-1] or "_"
        if end_of_chunk(prev, cur, prev_type, kind):
            out.append((prev_type, begin, i - 1))
        if start_of_chunk(prev, cur, prev_type, kind):
            begin = i
        prev, prev_type = cur, kind
    return set(out)


@pytest.mark.parametrize("seed", range(4))
def test_chunks_over_sentence_ends(spark, seed):
    rng = random.Random(seed)
    pick = lambda: rng.choice([0, 0, 0, 0, 1, 2, 2, 9, rng.randrange(14)])
    gold = [[pick() for _ in range(rng.choice([0, 1, 2, 5, 9]))] for _ in range(60)]
    pred = [[t if rng.random() < 0.8 else pick() for t in s] for s in gold]
    if seed == 0:
        gold[0], pred[0] = [0, 0], [0, 0]
    if seed == 1:
        gold[0], pred[0] = [], []
        gold[1], pred[1] = [0, 3], [0, 3]
    df = spark.createDataFrame([(i * 5, g, p) for i, (g, p) in enumerate(zip(gold, pred))], "id long, g array<int>, p array<int>").repartition(5)
    r = M.flat_entity_counts(df, "g", "p").first()
    a, b = chunks_by_scan(gold), chunks_by_scan(pred)
    assert (r.n_gold, r.n_pred, r.n_tp) == (len(a), len(b), len(a & b))


def test_flat_metrics_of_nothing(spark):
    r = M.entity_metrics_flat(spark.createDataFrame([], "id long, g array<int>, p array<int>"), "g", "p").first()
    assert (r.n_gold, r.n_pred, r.n_tp, r.f1) == (0, 0, 0, 0.0)


# ---- M4, U2

def test_version_corpora_are_the_single_ones(spark):
    rows = [(s, i, toks, [0] * len(toks), sub) for s in ("sentences", "documents") for i, (toks, sub) in enumerate(
        [(["a"], "train"), (["d'Or"], "train"), (["d'Or", "b"], "test"), (["20"], "test"), (["x", "y"], "test"), (["2", "d'Or"], "test"), ([], "validation")])]
    both = spark.createDataFrame(rows, "source string, key int, tokens array<string>, ner_tags array<bigint>, subset string")
    base, ext = both.filter("source = 'sentences'"), both.filter("source = 'documents'")
    all_versions = D.version_corpora(base, ext)
    for version, concat, numeric in D.version_flags():
        want = D.concat_splits(base, ext if concat else None, numeric_filter=numeric, test_apostrophe_filter=concat)
        got = D.of_version(all_versions, version)
        key = lambda d: sorted((r.source, r.key, r.subset) for r in d.collect())
        assert key(got) == key(want), version
    flags = {v: (c, n) for v, c, n in D.version_flags()}
    assert flags["_POC"][0] is False and flags["0.0.1"] == (True, False) and flags["0.0.6"] == (True, True)


# ---- M1, M2

def test_viterbi_is_the_best_of_all_sequences(spark):
    import itertools

    import numpy as np

    from tagtable.operators import sequence as Q

    rng = random.Random(6)
    rows = [(i, [rng.choice(["a", "b", "c", "dd", "Č"]) for _ in range(n)], [rng.randrange(3) for _ in range(n)]) for i, n in enumerate([0, 1, 2, 5, 5, 4, 3] * 4)]
    df = spark.createDataFrame(rows, "id int, tokens array<string>, ner_tags array<bigint>")
    model = Q.fit_sequence(df)
    small = Q.SequenceModel(model.emission[:, :4], model.transition[:4, :4], model.start[:4])
    for _, words, _ in rows[:7]:
        b = [int(__import__("hashlib").md5(w.encode()).hexdigest()[:4], 16) for w in words]

        def score(path):
            return sum(int(small.emission[x, t]) + int(small.start[t] if i == 0 else small.transition[path[i - 1], t]) for i, (x, t) in enumerate(zip(b, path)))

        assert score(Q.viterbi(np.array(b, int), small)) == max(map(score, itertools.product(range(4), repeat=len(b))))
    got = {r.id: r for r in Q.predict_sequence(df.withColumn("more", F.lit("x")), model).collect()}
    assert all(len(r.pred) == len(r.tokens) and r.more == "x" for r in got.values()) and len(got) == len(rows)


def test_sequence_tagger_without_rows(spark):
    from tagtable.operators import sequence as Q

    df = spark.createDataFrame([(1, ["a"], [3]), (2, None, None), (3, [None, "b"], [1, 99])], "id int, tokens array<string>, ner_tags array<bigint>")
    assert {r.id: r.pred for r in Q.predict_sequence(df, Q.fit_sequence(df.limit(0))).collect()} == {1: [0], 2: None, 3: [0, 0]}
    assert Q.fit_sequence(df).start[3] > Q.fit_sequence(df).start[0]


# ---- J3, J4, M3

def test_names_in_files_by_rarest_substring(spark):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("aab.1Č") for _ in range(n))
    names = [word(rng.randrange(9)) for _ in range(60)] + ["", None, "Model_V0.0.1.12"]
    files = [word(rng.randrange(14)) for _ in range(80)] + ["x_Model_V0.0.1.12.csv", "Model_V0.0.1.1", "", None]
    pairs = R.containing_files(spark.createDataFrame([(n,) for n in names], "n string"), spark.createDataFrame([(f,) for f in files], "f string"), "n", "f")
    assert sorted(map(tuple, pairs.collect())) == sorted({(n, f) for n in names for f in files if n and f and n in f})


def test_rungs_keep_the_best(spark):
    from tagtable.operators import tagger as T

    assert T.survivors({0: 0.5, 1: 0.7, 2: 0.7, 3: 0.1}, 0.5) == [1, 2] and T.survivors({4: 0.1, 2: 0.1, 9: 0.1}, 0.5) == [2, 4] and T.survivors({}, 0.5) == []
    df = spark.createDataFrame([(i, [f"w{i % 5}", "x"], [i % 5, 0]) for i in range(60)], "id int, tokens array<string>, t array<int>")
    rows = T.token_rows(df, tags="t")
    trials = T.random_trials(3, {"regParam": (0.0, 0.5)})
    run = lambda: T.sweep_rungs(rows, trials, budgets=(1, 5), num_features=64).collect()
    a = run()
    assert [(r.rung, r.trial, r.kept) for r in a] == [(r.rung, r.trial, r.kept) for r in run()] and [r.rung for r in a] == [0, 0, 0, 1, 1]
    assert {r.trial for r in a if r.rung == 0 and r.kept} == {r.trial for r in a if r.rung == 1} == set(T.survivors({r.trial: r.f1 for r in a if r.rung == 0}, 0.5))


def test_rungs_read_only_the_rows_they_need(spark):
    import os

    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    from tagtable.operators import tagger as T
    from tagtable.session import ensure_checkpoint_dir

    rng = random.Random(9)
    df = spark.createDataFrame([(i, [rng.choice("abc") + rng.choice(["", "Č", "1"]) for _ in range(4)], [rng.randrange(3) for _ in range(4)]) for i in range(80)],
                               "id int, tokens array<string>, t array<int>")
    rows, folder = T.token_rows(df, tags="t"), ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    got = T.sweep_rungs(rows, [{"regParam": 0.01}], budgets=(3,), num_features=64).first()
    (made,) = set(os.listdir(folder)) - before
    held = F.pmod(F.xxhash64(F.lit(42), F.col("id")), F.lit(5)) == 0
    n = {x: spark.read.parquet(f"{folder}/{made}/held={x}").count() for x in (0, 1)}
    assert n == {0: rows.filter(~held).count(), 1: rows.filter(held).count()} and min(n.values()) > 0
    hasher, lr = T.logreg_pipeline(num_features=64, max_iter=3, reg_param=0.01).getStages()
    data = hasher.transform(T._features(rows).withColumn("label", F.col("tag").cast("double")))
    plain = MulticlassClassificationEvaluator(metricName="f1").evaluate(lr.fit(data.filter(~held)).transform(data.filter(held)))
    assert abs(got.f1 - plain) < 0.02 and 0 < got.f1 < 1


def test_sweep_computes_features_once(spark):
    import os

    from tagtable.operators import tagger as T
    from tagtable.session import ensure_checkpoint_dir

    rows = T.token_rows(spark.createDataFrame([(i, [f"w{i % 5}", "X1"], [i % 5, 0]) for i in range(60)], "id int, tokens array<string>, t array<int>"), tags="t")
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    found = T.sweep(rows, {"regParam": [0.0, 0.1]}, num_features=64, max_iter=3)
    (made,) = set(os.listdir(folder)) - before
    assert spark.read.parquet(f"{folder}/{made}").count() == rows.count() and len(found.validationMetrics) == 2
    assert len(found.getEstimatorParamMaps()) == 2
    assert T.predict_logreg(found.bestModel, rows).filter("pred is not null").count() == rows.count()  # still a model of token rows


def test_version_corpora_test_each_word_once(spark):
    from tagtable.plans.queries import version_corpora_query

    plan = version_corpora_query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"RLIKE(lambda") + plan.count(r"RLIKE lambda") >= 1
    assert len([x for x in plan.splitlines() if r"\p{Nd})" in x and "exists(" in x]) == 1
