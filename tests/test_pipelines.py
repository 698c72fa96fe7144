"""Pipelines on small inputs: annotation, spans, modelling data, runs."""
from pyspark.sql import functions as F

from tagtable.functions.tokens import parse_int_repr, split_rejects
from tagtable.operators import runs as R
from tagtable.operators import tagger as T
from tagtable.plans import pipelines as P


def byte_level_predictor():
    class ByteLevelPredictor(T.FixturePredictor):
        """Spells its pieces as a byte-level tokenizer does."""

        def __call__(self, texts, keys):
            out = T.FixturePredictor.__call__(self, texts, keys)
            for pieces in out:
                for p in pieces:
                    p["word"] = p["word"].replace("ó", "Ã³")
            return out

    return ByteLevelPredictor


def test_tokens_come_from_the_sentence(spark):
    df = spark.createDataFrame([(1, "V októbri zaplatila firma", "v október zaplatiť firma"), (2, None, "x")], "id long, text string, lemma_text string")
    got = P.annotate_corpus(df, byte_level_predictor())
    row = got.filter("id = 1").first()
    assert row.tokens == ["V", "októbri", "zaplatila", "firma"] and len(row.model_tags) == 4
    odd = spark.createDataFrame([(1, ["a", "b"], ["a"], [0, 0]), (2, ["a"], ["a"], [0])], "id long, tokens array<string>, lemmas array<string>, model_tags array<int>")
    assert [r.id for r in P.annotation_mismatches(odd).collect()] == [1]
    assert P.annotate_corpus(df, byte_level_predictor(), limit=1).count() == 1


def test_annotation_with_corrections(spark):
    df = spark.createDataFrame([(1, "jeden dva tri", "jeden dva tri"), (2, "x y", "x y")], "id long, text string, lemma_text string")
    corr = spark.createDataFrame([(1, 1, 4, 1, "ok"), (1, 1, 5, 2, "ok"), (2, 0, 3, 3, "bad"), (1, 9, 2, 4, "ok")],
                                 "id long, token_index int, new_tag int, seq long, status string")
    plain = {r.id: r for r in P.annotate_corpus(df, T.FixturePredictor).collect()}
    got = {r.id: r for r in P.annotate_corpus(df, T.FixturePredictor, corrections=corr).collect()}
    assert got[2].fixed_tags == plain[2].fixed_tags
    assert got[1].fixed_tags == [plain[1].fixed_tags[0], 5, plain[1].fixed_tags[2]]


def test_predict_spans(spark):
    df = spark.createDataFrame([(1, "jeden dva tri styri pat sest sedem")], "id long, text string")
    spans = P.predict_spans(df, T.FixturePredictor).collect()
    text = df.first().text
    assert spans and all(text[r.start - 1 : r.start] in ("", " ") and text[r.end : r.end + 1] in ("", " ") for r in spans)


def test_modelling_dataset(spark):
    rows = [(1, "['a', 'b']", "[0, 1]"), (2, "['a', 'b']", "[0, 1]"), (3, "[]", "[]"), (4, "['a\\x', 'b']", "[0]"), (5, "['c']", "[3]")]
    df = spark.createDataFrame(rows, "id long, tokens string, fixed_tags string")
    out = {r.key: r for r in P.modelling_dataset(df, max_length=3, bucket=F.col("key") * 2000 - 1).collect()}
    assert out[1].tokens == ["a", "b", "<pad>"] and out[1].ner_tags == [0, 1, -100] and 2 not in out and out[3].tokens == ["<pad>"] * 3
    assert {k: r.subset for k, r in out.items() if k != 4} == {1: "train", 3: "train", 5: "test"}
    parsed = df.select("id", "tokens", P.parse_list("tokens").alias("p"))
    good, bad = split_rejects(parsed, "tokens", "p")
    assert good.count() + bad.count() == 5
    assert spark.createDataFrame([("[]",), ("[1  2]",)], "s string").select(parse_int_repr("s").alias("a")).collect()[0].a == []


def test_models_are_scored_on_their_own_rows(spark):
    rows = [(i, f"['w{i}' 'x' 'y']", "[0 1 2]", f"m{i % 3}", i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, tokens_repr string, ner_tags_repr string, model string, shift int")
    got = {r.model: r for r in P.evaluate_models(df, lambda p: T.FixturePredictor(shift=p["shift"]), ["shift"]).collect()}
    for m in range(3):
        pairs = [(g, (i * 7 + k * 13 + m) % 14) for i in range(60) if i % 3 == m for k, g in enumerate((0, 1, 2))]
        assert abs(got[f"m{m}"]["test/accuracy"] - sum(g == p for g, p in pairs) / len(pairs)) < 1e-6


def test_runs_are_sorted_and_compared(spark):
    cols = [c for _, cs in R.K.EVALUATION_COLUMNS for c in cs]
    names = [f"SlovakBERT_NER_Model_V0.0.{g}.{i}" for g in (1, 2) for i in range(4)]
    df = spark.createDataFrame([(n, *[float((k * 7 + j) % 5) for j in range(len(cols))]) for k, n in enumerate(names)], ["Name", *cols])
    got = [(r["test/f1"], r["test/recall"]) for r in R.sort_runs(df, ["test/f1", "test/recall"]).collect()]
    assert got == sorted(got, reverse=True)
    top = P.compare_runs(df, k=2)
    assert top.select("Name").distinct().count() == 4 and top.count() == 4 * len(cols)
    g = R.generations(df.select(R.parent_version("Name").alias("parent_version")))
    assert [r[0] for r in g.collect()] == ["SlovakBERT_NER_Model_V0.0.1", "SlovakBERT_NER_Model_V0.0.2"]


def test_training_history(spark):
    rows = [("r", 2 * i + j + 1, i + 1, 2 * i + j + 1, 0.5 if j == 0 else None, 0.4 if j else None, f if j else None)
            for i, f in enumerate([0.1, 0.3, 0.2, 0.2]) for j in (0, 1)]
    rec = spark.createDataFrame(rows, "run_id string, position long, epoch int, step long, loss double, eval_loss double, eval_f1 double")
    out = P.training_history(rec, patience=2).collect()
    assert len(out) == 4 and {(r.best_epoch, r.stop_epoch) for r in out} == {(2, 4)}
