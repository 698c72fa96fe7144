"""Registered queries over files: each writes a table that Spark derives from the driver's tables below
``spark.checkpoint.dir``, in the form the library's users keep it, and reads it back through the reader."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagtable.functions.tokens import parse_int_repr, repr_tokens_to_sentence
from tagtable.operators import metrics as M
from tagtable.operators import tagger as T
from tagtable.plans.pipelines import test_split_repr
from tagtable.session import scratch_path
from tagtable.sources import fixtures as fx
from tagtable.sources import outputs
from tagtable.sources.lines import csv_records, split_corrupt
from tagtable.sources.tables import first_rows, read_run_table, read_splits, read_table, run_stamp, write_table

EVENT_RUNS = ("click", "error", "purchase", "signup", "view")


def _ints(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


def sentences_csv(spark, sf):
    """Sentences with quotes, commas and line ends inside cells, some with an id that is no number."""
    s = fx.sentences(spark, sf)
    text = F.when(F.col("id") % 3 == 0, F.replace("text", F.lit(" o "), F.lit(' "o",\n\n'))).otherwise(F.col("text"))
    ident = F.concat(F.when(F.col("id") % 1000 == 7, F.lit("x")).otherwise(F.lit("")), F.col("id").cast("string"))
    path = scratch_path(spark, "sentences")
    write_table(s.select(ident.alias("id"), text.alias("text"), "lemma_text"), path, fmt="csv")
    good, bad = split_corrupt(csv_records(spark, path, "id bigint, text string, lemma_text string"))
    none = F.lit(None).cast("string")
    return good.select("id", "text", "lemma_text", F.lit(False).alias("rejected")).unionByName(
        bad.select(F.regexp_extract("_corrupt", '^"x([0-9]+)"', 1).cast("bigint").alias("id"), none.alias("text"), none.alias("lemma_text"), F.lit(True).alias("rejected")))


def first_sentences(spark, sf):
    """O1: the first 1,000 sentences by id."""
    return first_rows(fx.sentences(spark, sf), 1000).select("id", "text")


def run_table_csv(spark, sf):
    """A run table as CSV, its number columns found again."""
    path = scratch_path(spark, "runs")
    write_table(fx.run_table(spark, sf).drop("run_id"), path, fmt="csv")
    back = read_run_table(spark, path)
    return back.select("Name", "learning_rate", "num_train_epochs", *[F.col(f"`{c}`") for c in ("eval/f1", "test/f1", "test/macro_f1")])


def split_files(spark, sf):
    """An external corpus in a folder for each subset, label ids renamed while reading."""
    path = scratch_path(spark, "splits")
    write_table(fx.external_corpus(spark, sf), path, partition_by=["subset"])
    back = read_splits(spark, {x: f"{path}/subset={x}" for x in ("train", "validation", "test")}, label_map={0: 5, 5: 0})
    return back.select("doc_id", "subset", F.array_join("tokens", " ").alias("tokens"), _ints(F.col("ner_tags")).alias("ner_tags"))


def run_outputs(spark, sf):
    """K7: each event type's counts are a run's output; some runs are written twice, first with rows that must not
    stay, and one is left without rows."""
    counts = read_table(spark, sf, "events", ["user_id", "event_type"]).groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "outputs")
    of = lambda kind: counts.filter(F.col("event_type") == kind).drop("event_type")
    for kind in EVENT_RUNS[:2]:
        outputs.write_run(of(kind).select("user_id", (-F.col("n")).alias("n")).union(of(kind)), path, kind)
    outputs.write_run(of("view"), path, "withdrawn")
    for kind in (*EVENT_RUNS, "view"):
        outputs.write_run(of(kind), path, kind)
    outputs.write_run(of("view").limit(0), path, "withdrawn")
    rows = outputs.read_runs(spark, path).join(outputs.run_manifest(spark, path).select("run", "n_rows"), "run")
    return rows.select("run", "user_id", "n", "n_rows")


def metrics_table(spark, sf):
    """K2: named metrics rows, one written again."""
    a = fx.annotated_sentences(spark, sf)
    path = scratch_path(spark, "metrics")
    rows = M.token_metrics(M.confusion(M.gold_pred_pairs(a, "fixed_tags", "model_tags")))
    for name in ("V0.0.1", "V0.0.2", "V0.0.1"):
        outputs.put_metrics(rows, path, name)
    return outputs.read_metrics(spark, path).select("Name", *[F.col(f"`{c}`") for c in rows.columns])


def split_text(spark, sf):
    """The test split saved as list texts and read back."""
    a = fx.annotated_sentences(spark, sf).filter(fx.subset_of("id") == "test")
    path = scratch_path(spark, "test-split")
    write_table(test_split_repr(a, tags="fixed_tags").select("id", "tokens_repr", "ner_tags_repr"), path, fmt="csv")
    back, _ = split_corrupt(csv_records(spark, path, "id bigint, tokens_repr string, ner_tags_repr string"))
    return back.select("id", repr_tokens_to_sentence("tokens_repr").alias("text"), _ints(parse_int_repr("ner_tags_repr")).alias("tags"))


def saved_majority(spark, sf):
    """M5: the majority tagger, saved and loaded."""
    a = fx.annotated_sentences(spark, sf)
    path = scratch_path(spark, "model")
    T.save_model(T.fit_majority(T.token_rows(a, tags="fixed_tags")), path)
    return T.load_model(spark, path, majority=True).select("token", "tag")


def run_stamps(spark, sf):
    """C20: the stamp of every event's time."""
    return read_table(spark, sf, "events", ["event_id", "ts"]).select("event_id", run_stamp(F.col("ts")).alias("stamp"))


QUERIES = {f.__name__: f for f in (sentences_csv, first_sentences, run_table_csv, split_files, run_outputs, metrics_table, split_text,
                                   saved_majority, run_stamps)}
