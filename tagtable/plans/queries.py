"""Registered queries: one per operator of the inventory, each reading the
driver's tables (or what Spark derives from them) over their whole extent.

Array results are returned as joined strings so they compare as values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagtable.functions.labels import align_labels, argmax, drop_masked, label_id, label_name
from tagtable.functions.normalize import normalize
from tagtable.functions.arrays import computed_once
from tagtable.functions.tokens import parse_list, split_rejects, tokenize
from tagtable.operators import corrections as C
from tagtable.operators import datasets as D
from tagtable.operators import metrics as M
from tagtable.operators import runs as R
from tagtable.operators import sequence as Q
from tagtable.operators import tagger as T
from tagtable.operators.positions import positions
from tagtable.operators.pieces import piece_word_ids, words_from_pieces
from tagtable.operators.spans import entity_spans, spans_from_pieces
from tagtable.plans.io_queries import QUERIES as IO_QUERIES
from tagtable.session import cut_lineage, scratch_path, small_arrow_batches, stored
from tagtable.sources import fixtures as fx
from tagtable.sources.tables import read_history_lines, read_table, spread, write_history_lines

Query = Callable[[SparkSession, str], DataFrame]


def _ints(c) -> F.Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


# -- step 1: normalise, tokenise ---------------------------------------------
def normalize_sentences(spark, sf):
    s = fx.sentences(spark, sf)
    return s.select("id", normalize("text").alias("text"), normalize("lemma_text").alias("lemma_text"))


def normalize_documents(spark, sf):
    d = spread(read_table(spark, sf, "documents", ["doc_id", "text"]), "doc_id")
    return d.select("doc_id", normalize("text").alias("text"))


def token_counts(spark, sf):
    d = spread(read_table(spark, sf, "documents", ["doc_id", "text"]), "doc_id")
    toks = tokenize(normalize("text"))
    return d.select("doc_id", F.size(toks).cast("bigint").alias("n_tokens"))


# -- step 2: labels and rules ------------------------------------------------
def fix_tags_query(spark, sf):
    a = fx.annotated_sentences(spark, sf)
    return a.select("id", F.array_join("tokens", " ").alias("tokens"),
                    _ints(F.col("model_tags")).alias("model_tags"),
                    _ints(F.col("fixed_tags")).alias("fixed_tags"))


def fix_tag_counts(spark, sf):
    a = fx.annotated_sentences(spark, sf)
    # explode_outer: a plain explode makes Catalyst infer a size() filter and
    # push it below the projections, re-running the whole rule chain there.
    return (a.select(F.explode_outer("fixed_tags").alias("tag"))
            .filter(F.col("tag").isNotNull())
            .groupBy("tag").agg(F.count("*").alias("n"))
            .select(label_name("tag").alias("label"), "n"))


def _piece_sentences(spark, sf):
    t = fx.tokenized_sentences(spark, sf)
    return t.select("id", fx.pieces("id", "tokens").alias("pieces"))


def pieces_to_words(spark, sf):
    w = _piece_sentences(spark, sf).select("id", words_from_pieces("pieces").alias("w"))
    return w.select(
        "id",
        F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("words"),
        _ints(F.transform("w", lambda x: label_id(x["entity"]))).alias("tags"),
        _ints(F.transform("w", lambda x: x["start"])).alias("starts"),
        _ints(F.transform("w", lambda x: x["end"])).alias("ends"),
    )


def align_labels_query(spark, sf):
    a = fx.annotated_sentences(spark, sf).select("id", "tokens", "fixed_tags")
    a = a.withColumn("wids", piece_word_ids(fx.pieces("id", "tokens")))
    return a.select("id", _ints(F.col("wids")).alias("word_ids"),
                    _ints(align_labels("wids", "fixed_tags")).alias("labels"),
                    _ints(align_labels("wids", "fixed_tags", label_all_tokens=False)).alias("labels_first"))


def argmax_labels(spark, sf):
    e = read_table(spark, sf, "embeddings", ["vec_id", "embedding", "label"])
    return e.select("vec_id", argmax("embedding").alias("pred"), "label")


# -- step 3: metrics ---------------------------------------------------------
def _conf(spark, sf):
    a = fx.annotated_sentences(spark, sf)
    return M.confusion(M.gold_pred_pairs(a, "fixed_tags", "model_tags"))


def confusion_query(spark, sf):
    return _conf(spark, sf)


def confusion_percent_query(spark, sf):
    return M.confusion_percent(_conf(spark, sf))


def confusion_totals_query(spark, sf):
    return M.confusion_totals(_conf(spark, sf))


def token_metrics_query(spark, sf):
    return M.token_metrics(_conf(spark, sf))


def class_report_query(spark, sf):
    return M.class_report(_conf(spark, sf))


def entity_metrics_query(spark, sf):
    a = fx.annotated_sentences(spark, sf)
    return M.entity_metrics(a.select("fixed_tags", "model_tags"), "fixed_tags", "model_tags", ids=True)


# -- step 6: spans -----------------------------------------------------------
def entity_spans_query(spark, sf):
    p = _piece_sentences(spark, sf)
    return (p.select("id", entity_spans("pieces").alias("s")).select("id", F.inline_outer("s"))
            .filter(F.col("type").isNotNull()).select("id", "type", "start", "end"))


def accepted_spans_query(spark, sf):
    p = _piece_sentences(spark, sf)
    # Spans in a projection of their own, next to the pieces': one Arrow step makes both.
    return p.select("id", spans_from_pieces("pieces").alias("s")).select("id", F.inline_outer("s")).filter(F.col("type").isNotNull())


# -- step 4: datasets ---------------------------------------------------------
def modelling_corpus(spark, sf):
    """Annotated sentences as a modelling corpus: copies dropped (the
    smallest id survives), subset from the surviving id."""
    a = fx.annotated_sentences(spark, sf).select(
        "id", "tokens", F.col("fixed_tags").cast("array<bigint>").alias("ner_tags"))
    d = D.dedup(a, ["tokens", "ner_tags"], keep="id")
    return d.select(F.lit("sentences").alias("source"), F.col("id").alias("key"), "tokens", "ner_tags",
                    fx.subset_of("id").alias("subset"))


def external(spark, sf):
    e = fx.external_corpus(spark, sf)
    return e.select(F.lit("documents").alias("source"), F.col("doc_id").alias("key"), "tokens", "ner_tags",
                    "subset")


def filter_numeric_query(spark, sf):
    e = D.filter_numeric(fx.external_corpus(spark, sf))
    return e.select("doc_id", "subset", F.size("tokens").cast("bigint").alias("n_tokens"))


def filter_apostrophe_query(spark, sf):
    e = fx.external_corpus(spark, sf, subset="test")
    return D.filter_apostrophe(e).select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"))


def dedup_query(spark, sf):
    d = D.dedup(fx.external_corpus(spark, sf), ["tokens", "ner_tags"], keep="doc_id", count_col="copies")
    return d.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), "copies")


def _concat(spark, sf):
    return D.concat_splits(modelling_corpus(spark, sf), external(spark, sf))


def concat_splits_query(spark, sf):
    c = _concat(spark, sf)
    return c.select("source", "key", "subset", F.size("tokens").cast("bigint").alias("n_tokens"))


def split_sizes_query(spark, sf):
    return D.split_sizes(_concat(spark, sf))


def distribution_query(spark, sf):
    """K6 over the concatenated corpus. Only counts are needed, so copies meet
    under a digest and no token array is shuffled."""
    counted = [F.size("tokens").alias("n_tokens"), D.label_counts("ner_tags").alias("counts"), D.has_apostrophe("tokens").alias("odd")]
    a = fx.annotated_sentences(spark, sf).select("id", "tokens", F.col("fixed_tags").cast("array<bigint>").alias("ner_tags"))
    own = D.dedup_by_digest(a.select("*", *counted), ["tokens", "ner_tags"], "id", ["n_tokens", "counts", "odd"])
    own = own.select(fx.subset_of("id").alias("subset"), "n_tokens", "counts", "odd")
    ext = D.filter_numeric(external(spark, sf)).select("subset", *counted)
    both = own.unionByName(ext).filter((F.col("subset") != "test") | ~F.col("odd"))
    return D.distribution_of_counts(both)


# -- step 5: review and corrections -------------------------------------------
def _review(spark, sf):
    """Annotated sentences with their 1-based row number in id order. Numbers
    come from the raw ids (no text work) and are joined on the unique id."""
    a = fx.annotated_sentences(spark, sf).select("id", "tokens", "fixed_tags")
    return a.join(positions(fx.sentences(spark, sf).select("id"), "id", out="row"), "id")


def review_blocks_query(spark, sf):
    return C.review_blocks(_review(spark, sf), "row")


def filled_blocks(spark, sf):
    """A reviewer's answers for every token: most keep the label, every
    17th changes it, some are left empty (rejects), and a second pass
    changes half of the changed ones again (the last one must win)."""
    return _filled(_review(spark, sf))


def _filled(numbered):
    r = C.review_rows(numbered, "row")
    h = F.pmod(F.col("id") * 3 + F.col("token_index"), F.lit(17))
    new1 = (F.when(h == 1, F.lit("")).when(h == 0, label_name(F.pmod(F.col("tag") + 1, F.lit(14))))
            .otherwise(label_name(F.col("tag"))))
    seq = F.col("row") * 1000 + F.col("token_index")
    word, idx, row = F.col("word"), F.col("token_index"), F.col("row")
    first = F.struct(C.block_text(row, F.col("id"), idx, word, label_name(F.col("tag")), new1).alias("block"),
                     F.lit(1).alias("pass"), seq.alias("seq"))
    second = F.when((h == 0) & (F.pmod(F.col("id"), F.lit(2)) == 0), F.struct(
        C.block_text(row, F.col("id"), idx, word, label_name(F.pmod(F.col("tag") + 1, F.lit(14))),
                     label_name(F.pmod(F.col("tag") + 2, F.lit(14)))).alias("block"),
        F.lit(2).alias("pass"), (F.lit(10**15) + seq).alias("seq")))
    # Both review passes come from one scan of the token rows.
    return r.select(F.inline(F.filter(F.array(first, second), lambda x: x.isNotNull())))


def parse_corrections_query(spark, sf):
    p = C.parse_corrections(filled_blocks(spark, sf))
    return p.select("id", "token_index", "new_tag", "new_label", "status", "pass")


def apply_corrections_query(spark, sf):
    a = cut_lineage(fx.annotated_sentences(spark, sf).select("id", "tokens", "fixed_tags", F.col("id").alias("row")))
    corr = C.parse_corrections(_filled(a))
    out = C.apply_corrections(a, corr, out="corrected_tags")
    return out.select("id", _ints(F.col("fixed_tags")).alias("fixed_tags"),
                      _ints(F.col("corrected_tags")).alias("corrected_tags"))


def correction_order_query(spark, sf):
    """Corrections from two sources for the same tokens; the second
    source wins wherever both answer."""
    a = cut_lineage(fx.annotated_sentences(spark, sf).select("id", "tokens", "fixed_tags", F.col("id").alias("row")))
    corr = C.parse_corrections(_filled(a))
    seq = F.struct(F.col("pass").alias("nth"), F.lit("").alias("file"), F.lit(0).alias("start"), F.col("seq").alias("row"), F.lit(0).alias("part"))
    corr = corr.filter((F.col("pass") == 2) | (F.pmod("token_index", F.lit(2)) == 0)).withColumn("seq", seq)
    out = C.apply_corrections(a, corr, out="corrected_tags")
    return out.select("id", _ints(F.col("corrected_tags")).alias("corrected_tags"))


# -- step 7: runs --------------------------------------------------------------
def _records(spark, sf):
    kept = R.keep_step_records(fx.history_records(spark, sf))
    pos = positions(kept, "event_id", by=["run_id"])
    return pos.withColumn("step", F.col("position")).withColumn(
        "epoch", F.floor((F.col("position") + 1) / 2).cast("int"))


def _pairs(spark, sf):
    return R.history_pairs(_records(spark, sf))


def history_pairs_query(spark, sf):
    p = _pairs(spark, sf)
    return p.select("run_id", "epoch", "step", F.round("loss", 6).alias("loss"),
                    F.round("eval_loss", 6).alias("eval_loss"), F.round("eval_f1", 6).alias("eval_f1"))


def best_epoch_query(spark, sf):
    b = R.best_epoch(_pairs(spark, sf))
    return b.select("run_id", "best_epoch", F.round("best_eval_f1", 6).alias("best_eval_f1"))


def early_stop_query(spark, sf):
    return R.early_stop(_pairs(spark, sf), patience=3)


def parent_version_query(spark, sf):
    r = fx.run_table(spark, sf)
    return r.select("Name", R.parent_version("Name").alias("parent_version"))


def top_runs_query(spark, sf):
    r = fx.run_table(spark, sf).select("Name", "`test/macro_f1`", R.parent_version("Name").alias("parent_version"))
    return R.top_k_per_group(r, "parent_version", [F.col("`test/macro_f1`").asc(), R.natural_key("Name").asc()], 10)


def natural_sort_query(spark, sf):
    return fx.run_table(spark, sf).select("Name", R.natural_key("Name").alias("natural_key"))


def next_version_query(spark, sf):
    return R.next_version(fx.run_table(spark, sf))


def model_dataset_match_query(spark, sf):
    runs = fx.run_table(spark, sf)
    m = R.match_models_to_files(runs.select("Name"), fx.test_files(runs))
    version = F.regexp_extract("Name", r"V(_POC|[0-9]+\.[0-9]+\.[0-9]+)", 1)
    return m.select("Name", "file", "matched_by", R.version_test_rows(version).alias("test_rows"))


def param_grid_query(spark, sf):
    ev = read_table(spark, sf, "events", ["value"])
    vals = ev.select((F.pmod(F.floor("value"), F.lit(3)) / 10.0).alias("v"))
    return R.param_grid_from_values(vals, "v", ["hidden_dropout_prob", "attention_probs_dropout_prob",
                                                 "classifier_dropout"])


CONFIG_DEFAULTS = {"learning_rate": 5e-05, "num_train_epochs": 15.0, "per_device_train_batch_size": 4.0,
                   "weight_decay": 0.0, "warmup_steps": 0.0, "seed": 42.0}


def config_overlay_query(spark, sf):
    runs = fx.run_table(spark, sf)
    u = F.col("run_id")
    ov = runs.select(
        "run_id",
        F.when(F.pmod(u, F.lit(3)) == 0, F.col("learning_rate")).alias("learning_rate"),
        F.when(F.pmod(u, F.lit(5)) == 0, F.col("num_train_epochs").cast("double")).alias("num_train_epochs"),
        F.lit(None).cast("double").alias("per_device_train_batch_size"),
        F.when(F.pmod(u, F.lit(2)) == 1, F.lit(0.01)).alias("weight_decay"),
        F.lit(None).cast("double").alias("warmup_steps"),
        F.lit(None).cast("double").alias("seed"),
    )
    out = R.config_overlay(ov, CONFIG_DEFAULTS)
    return out.select("run_id", "param", F.col("value").cast("double").alias("value"), "overridden")


def metrics_long_query(spark, sf):
    return R.metrics_long(fx.run_table(spark, sf))


# -- step 8: tagger and pipelines ----------------------------------------------
def annotate_corpus_query(spark, sf):
    """L1 end to end with the fixture model run through mapInArrow and the
    reviewer's corrections applied. The corpus is annotated once; the
    reviewer's blocks are written from that annotation (their display row,
    which nothing reads back, is the id) and applied to it."""
    from tagtable.plans.pipelines import annotate_corpus

    a = cut_lineage(annotate_corpus(fx.sentences(spark, sf), T.FixtureBatchPredictor).select("id", "tokens", "model_tags", "fixed_tags"))
    out = C.apply_corrections(a, C.parse_corrections(_filled(a.withColumn("row", F.col("id")))))
    return out.select("id", F.array_join("tokens", " ").alias("tokens"), _ints(F.col("model_tags")).alias("model_tags"),
                      _ints(F.col("fixed_tags")).alias("fixed_tags"))


def predict_spans_query(spark, sf):
    """Raw text to accepted spans with the fixture model."""
    from tagtable.plans.pipelines import predict_spans

    return predict_spans(fx.sentences(spark, sf), T.FixtureBatchPredictor)


def modelling_dataset_query(spark, sf):
    """L2: annotated sentences as list text, parsed, deduplicated, split by
    an integer bucket and padded."""
    from tagtable.plans.pipelines import modelling_dataset

    a = fx.annotated_sentences(spark, sf).select(
        "id", F.to_json("tokens").alias("tokens"), F.to_json("fixed_tags").alias("fixed_tags"))
    out = modelling_dataset(a, bucket=F.pmod(F.col("key") * 97, F.lit(10000)), max_length=24)
    return out.select("key", F.array_join("tokens", " ").alias("tokens"), _ints(F.col("ner_tags")).alias("ner_tags"), "subset")


def _with_masked(spark, sf):
    a = fx.annotated_sentences(spark, sf).select("id", "fixed_tags", "model_tags")
    gold = F.transform("fixed_tags", lambda t, i: F.when(F.pmod(i, F.lit(5)) == 4, F.lit(-100)).otherwise(t))
    pairs = F.arrays_zip(gold.alias("label"), F.col("model_tags").alias("pred"))
    return a.select("id", drop_masked(pairs, "label").alias("p"))


def masked_accuracy_query(spark, sf):
    """positions labelled -100 are dropped before tokens are compared."""
    e = _with_masked(spark, sf)
    return e.agg(F.sum(F.size("p")).alias("n_tokens"),
                 F.sum(F.size(F.filter("p", lambda x: x["label"] == x["pred"]))).alias("n_equal"))


def _split_rows(spark, sf):
    """Train and test token rows. The corpus is annotated and deduplicated
    once and read twice from a reliable checkpoint."""
    mc = cut_lineage(modelling_corpus(spark, sf).withColumnRenamed("key", "id"))
    return tuple(T.token_rows(mc.filter(F.col("subset") == x)) for x in ("train", "test"))


def majority_tagger_query(spark, sf):
    train, test = _split_rows(spark, sf)
    pred = T.predict_majority(test, T.fit_majority(train))
    return pred.select("id", "idx", "token", "tag", "pred")


def logreg_tagger_query(spark, sf):
    """M1, M2: the fitted tagger beside the majority one on the test rows. Its
    predictions are no SQL, so the result is the rows it tagged per gold tag
    and whether it is at least as accurate overall."""
    train, test = _split_rows(spark, sf)
    model = T.fit_logreg(train, max_iter=10, num_features=1 << 14)
    both = T.predict_majority(T.predict_logreg(model, test, out="fitted"), T.fit_majority(train), out="majority")
    hits = both.groupBy("tag").agg(F.count("fitted").alias("n_tagged"), F.sum((F.col("fitted") == F.col("tag")).cast("long")).alias("h"),
                                   F.sum((F.col("majority") == F.col("tag")).cast("long")).alias("m"))
    whole = Window.partitionBy()  # one row per tag
    return hits.select("tag", "n_tagged", (F.sum("h").over(whole) >= F.sum("m").over(whole)).alias("at_least_majority"))


def preset_configs_query(spark, sf):
    """M4: each run's configuration by the preset of its version."""
    version = F.regexp_extract("Name", r"V(_POC|[0-9]+\.[0-9]+\.[0-9]+)", 1)
    return R.preset_overlay(fx.run_table(spark, sf), version)


def sweep_trials_query(spark, sf):
    """M3: a grid of trials on the train rows; the grid and the rows' form are
    compared, the scores only as being within bounds."""
    train, _ = _split_rows(spark, sf)
    grid = {"regParam": [0.0, 0.1], "elasticNetParam": [0.0, 0.5]}
    t = T.sweep_trials(train, grid, num_features=1 << 12, max_iter=3)
    return t.select("repeat", "trial", "regParam", "elasticNetParam", F.col("f1").between(0, 1).alias("scored"))


# -- the same operators over whole documents: rows of 0 to 20,000 words ----------
def document_fix_tags_query(spark, sf):
    a = fx.annotated_documents(spark, sf)
    return a.select("id", F.array_join("tokens", " ").alias("tokens"), _ints(F.col("model_tags")).alias("model_tags"),
                    _ints(F.col("fixed_tags")).alias("fixed_tags"))


def document_class_report_query(spark, sf):
    a = fx.annotated_documents(spark, sf)
    return M.class_report(M.confusion(M.gold_pred_pairs(a, "fixed_tags", "model_tags")))


def document_entity_metrics_query(spark, sf):
    a = fx.annotated_documents(spark, sf)
    return M.entity_metrics(a.select("fixed_tags", "model_tags"), "fixed_tags", "model_tags", ids=True)


def _document_pieces(spark, sf):
    small_arrow_batches(spark)
    a = fx.annotated_documents(spark, sf).filter(F.size("tokens") > 0)
    return a.select("id", fx.pieces("id", "tokens").alias("pieces"))


def document_words_query(spark, sf):
    w = _document_pieces(spark, sf).select("id", words_from_pieces("pieces").alias("w"))
    return w.select("id", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("words"),
                    _ints(F.transform("w", lambda x: label_id(x["entity"]))).alias("tags"),
                    _ints(F.transform("w", lambda x: x["start"])).alias("starts"),
                    _ints(F.transform("w", lambda x: x["end"])).alias("ends"))


def document_spans_query(spark, sf):
    p = _document_pieces(spark, sf)
    return p.select("id", spans_from_pieces("pieces").alias("s")).select("id", F.inline_outer("s")).filter(F.col("type").isNotNull())


def annotation_mismatches_query(spark, sf):
    """Q6: rows whose lemmas do not pair with their words."""
    from tagtable.plans.pipelines import annotation_mismatches

    return annotation_mismatches(fx.annotated_documents(spark, sf))


def _fixture_model(params: dict):
    return T.FixturePredictor(shift=int(params["run_id"]) % 14)


def evaluate_models_query(spark, sf):
    """L3 + L4: every model that has a test file is scored on that file's
    rows. Test rows belong to one file each, by id over the files in order."""
    from tagtable.plans.pipelines import evaluate_models, test_split_repr

    # The runs and their files are found once; nothing that grows with them is broadcast or planned again.
    runs = cut_lineage(fx.run_table(spark, sf).select("run_id", "Name"))
    matched = R.match_models_to_files(runs.select("Name"), fx.test_files(runs)).filter(F.col("file").isNotNull())
    work = cut_lineage(matched.select("Name", "file").join(runs.hint("merge"), "Name"))
    files = cut_lineage(work.select("file").distinct().withColumn("_o", F.conv(F.substring(F.md5("file"), 1, 12), 16, 10).cast("long")))
    ranked = positions(files, "_o", out="nth", ties=[F.col("file")]).select("file", (F.col("nth") - 1).alias("nth"))
    models = cut_lineage(ranked.join(work.hint("merge"), "file"))
    n = files.count()
    test = test_split_repr(modelling_corpus(spark, sf).filter(F.col("subset") == "test")).withColumnRenamed("key", "id")
    test = test.withColumn("nth", F.pmod(F.col("id"), F.lit(max(n, 1))))
    rows = test.join(models.hint("merge"), "nth")
    return evaluate_models(rows, _fixture_model, ["run_id"], model="Name")


def version_folder_query(spark, sf):
    """The least run folder whose name contains each version."""
    runs = fx.run_table(spark, sf)
    versions = runs.select(F.regexp_extract("Name", r"V(_POC|[0-9]+\.[0-9]+\.[0-9]+)", 1).alias("version")).distinct()
    return R.pick_version_folder(versions, runs.select(F.col("Name").alias("folder")))


def compare_runs_query(spark, sf):
    """The runs with the lowest macro F1 of each generation, in long form."""
    from tagtable.plans.pipelines import compare_runs

    return compare_runs(fx.run_table(spark, sf), k=5)


def sorted_runs_query(spark, sf):
    """Runs ordered by several metrics; the place is made a column."""
    runs = R.sort_runs(fx.run_table(spark, sf), ["test/macro_f1", "test/f1"])
    return runs.select("Name", R.parent_version("Name").alias("parent_version"), "`test/macro_f1`", "`test/f1`")


def generations_query(spark, sf):
    return R.generations(fx.run_table(spark, sf).select(R.parent_version("Name").alias("parent_version")))


def training_history_query(spark, sf):
    """Merged records with the best and the early-stopping epoch."""
    from tagtable.plans.pipelines import training_history

    h = training_history(_records(spark, sf).drop("event_id"), patience=3)
    return h.select("run_id", "epoch", "step", F.round("eval_f1", 6).alias("eval_f1"), "best_epoch", "stop_epoch", "n_evals")


def evaluation_checks_query(spark, sf):
    """Row-level checks of a scored table, with sentences cut short on
    purpose and labels outside the dictionary."""
    a = fx.annotated_sentences(spark, sf).select("id", "fixed_tags", "model_tags")
    cut = F.when(F.pmod("id", F.lit(9)) == 0, F.slice("model_tags", 1, 5)).otherwise(F.col("model_tags"))
    odd = F.transform("fixed_tags", lambda t, i: F.when((F.pmod(F.col("id"), F.lit(11)) == 0) & (i == 2), F.lit(20)).otherwise(t))
    return M.evaluation_checks(a.select(odd.alias("gold"), cut.alias("pred")), "gold", "pred")


# -- list texts, review files, histories, exact splits, one long sequence -------
def list_texts(spark, sf):
    """``doc_id, raw``: each document's plain words as the text of a Python list, with both quotes, escapes of every
    length and strings side by side; some rows are cut short or hold an escape without a character."""
    d = spread(read_table(spark, sf, "documents", ["doc_id", "text"]), "doc_id")
    words = F.regexp_extract_all("text", F.lit("[a-z]+"), 0)
    forms = ["'%'", '"%\'s"', r"""'%\n"'""", r"'\xe1%'", r"'\u013e%\\'", r"'\U0001f600%' 'x'"]
    shape = F.array(*[F.lit(f) for f in forms])
    quoted = F.transform(words, lambda w, i: F.replace(F.get(shape, i % len(forms)), F.lit("%"), w))
    odd = F.when(F.col("doc_id") % 13 == 1, F.concat(quoted, F.array(F.lit(r"'\ud800'")))).otherwise(quoted)
    joined = F.concat(F.lit("["), F.array_join(odd, ", \n "), F.when(F.col("doc_id") % 13 == 0, F.lit("")).otherwise(F.lit("]")))
    return d.select("doc_id", computed_once(joined).alias("raw"))


def parse_lists_query(spark, sf):
    """List texts to arrays, and the rows that are rejected."""
    parsed = list_texts(spark, sf).withColumn("parsed", computed_once(parse_list("raw")))  # not once more in the filter
    good, bad = split_rejects(parsed, "raw", "parsed")
    return good.select("doc_id", F.array_join("parsed", "|").alias("elements"), F.lit(False).alias("rejected")).unionByName(
        bad.select("doc_id", F.lit(None).cast("string").alias("elements"), F.lit(True).alias("rejected")))


def review_files_query(spark, sf):
    """K4, S7, J1 over files: both review passes are written as block files, the second with CRLF line ends, read back
    as lines and applied."""
    a = stored(fx.annotated_sentences(spark, sf).select("id", "tokens", "fixed_tags"), "annotated").withColumn("row", F.col("id"))
    answers = _filled(a)
    paths = []
    for nth in (1, 2):
        text = F.col("block") if nth == 1 else F.replace(F.col("block"), F.lit("\n"), F.lit("\r\n"))
        paths.append(scratch_path(spark, f"review-{nth}"))
        C.write_review_blocks(answers.filter(F.col("pass") == nth).select(text.alias("block")), paths[-1], crlf=nth == 2)
    out = C.apply_corrections(a, C.parse_corrections(C.read_correction_blocks(spark, paths)), out="corrected_tags")
    return out.select("id", _ints(F.col("corrected_tags")).alias("corrected_tags"))


def history_merge_query(spark, sf):
    """Records with keys that nobody names are written as JSON lines, read back and merged pairwise."""
    ev = _records(spark, sf).join(read_table(spark, sf, "events", ["event_id", "event_type"]), "event_id")
    named = {c: F.col(c) for c in ("loss", "eval_loss", "eval_f1")}
    named["learning_rate"] = F.col("event_id") / 1024
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), v.cast("double").alias("v")) for k, v in named.items()],
                    F.struct(F.concat(F.lit("extra_"), "event_type", F.lit("_"), (F.col("event_id") % 3).cast("string")).alias("k"),
                             F.col("event_id").cast("double").alias("v")))
    path = scratch_path(spark, "history")
    write_history_lines(ev.select("run_id", "position", F.map_from_entries(F.filter(pairs, lambda x: x["v"].isNotNull())).alias("record")), path)
    m = R.merge_history(read_history_lines(spark, path, "bigint"))
    value = lambda k: F.round(F.col("record")[k].cast("double"), 6).alias(k)
    extras = F.filter(F.map_entries("record"), lambda e: e["key"].startswith("extra_"))
    shown = F.transform(extras, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("double").cast("bigint").cast("string")))
    return m.select("run_id", "pair", F.array_join(F.sort_array(F.map_keys("record")), ",").alias("keys"), *[value(k) for k in named],
                    F.array_join(F.sort_array(shown), ",").alias("extras"))


def exact_split_query(spark, sf):
    """Subsets of exact size, in the order of a seeded digest of the key."""
    d = read_table(spark, sf, "documents", ["doc_id"])
    order = F.conv(F.substring(F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(":42"))), 1, 15), 16, 10).cast("long")
    return D.assign_exact_subset(d, "doc_id", order=order)


def entity_metrics_flat_query(spark, sf):
    """A7 over the corpus as one sequence, and over the same corpus with runs of '0' cut across its sentences' ends."""
    a = stored(fx.annotated_sentences(spark, sf).select("id", "fixed_tags", "model_tags"), "annotated")  # read by both
    zero = lambda c, k: F.transform(c, lambda t, i: F.when((F.pmod("id", F.lit(4)) < k) & ((i < 2) | (i > F.size(c) - 3)), 0).otherwise(t))
    b = a.select("id", computed_once(zero("fixed_tags", 3)).alias("fixed_tags"), computed_once(zero("model_tags", 2)).alias("model_tags"))
    return M.entity_metrics_flat(a, "fixed_tags", "model_tags").withColumn("corpus", F.lit("plain")).unionByName(
        M.entity_metrics_flat(b, "fixed_tags", "model_tags").withColumn("corpus", F.lit("open runs")))


def sweep_rungs_query(spark, sf):
    """M3: a random search stopped early: per rung its fits and survivors, and whether these are the best by the stored scores."""
    train, _ = _split_rows(spark, sf)
    trials = T.random_trials(4, {"regParam": (0.0, 0.2), "elasticNetParam": (0.0, 0.5)})
    rows = T.sweep_rungs(train, trials, budgets=(2, 4, 8), num_features=1 << 12)
    place = F.row_number().over(Window.partitionBy("rung").orderBy(F.desc("f1"), "trial"))
    n = F.count(F.lit(1)).over(Window.partitionBy("rung"))
    ruled = rows.withColumn("_ok", (place <= F.ceil(n / 2)) == F.col("kept"))
    return ruled.groupBy("rung", "budget").agg(F.count(F.lit(1)).alias("n_trials"), F.sum(F.col("kept").cast("long")).alias("n_kept"),
                                               F.bool_and("_ok").alias("best_kept"), F.bool_and(F.col("f1").between(0, 1)).alias("scored"))


def version_corpora_query(spark, sf):
    """Rows and tokens per subset of every version's corpus."""
    return D.version_distribution(D.version_corpora(modelling_corpus(spark, sf), external(spark, sf)))


def sequence_tagger_query(spark, sf):
    """M1, M2: the sequence tagger's labels of each test sentence, and how many of its words it and the majority tagger get right."""
    mc = cut_lineage(modelling_corpus(spark, sf).select(F.col("key").alias("id"), "tokens", "ner_tags", "subset"))
    train, test = (mc.filter(F.col("subset") == x) for x in ("train", "test"))
    pred = Q.predict_sequence(test.select("id", "tokens", "ner_tags"), Q.fit_sequence(train))
    majority = T.predict_majority(T.token_rows(test), T.fit_majority(T.token_rows(train)), out="m")
    by_id = majority.groupBy("id").agg(F.sum((F.col("m") == F.col("tag")).cast("long")).alias("n_majority"))
    right = F.size(F.filter(F.arrays_zip(F.col("ner_tags").alias("a"), F.col("pred").alias("b")), lambda z: z["a"] == z["b"]))
    return pred.join(by_id, "id", "left").select("id", _ints(F.col("pred")).alias("pred"), right.cast("long").alias("n_right"),
                                                  F.coalesce("n_majority", F.lit(0)).alias("n_majority"))


QUERIES: dict[str, Query] = {
    "normalize_sentences": normalize_sentences,
    "normalize_documents": normalize_documents,
    "token_counts": token_counts,
    "fix_tags": fix_tags_query,
    "fix_tag_counts": fix_tag_counts,
    "pieces_to_words": pieces_to_words,
    "align_labels": align_labels_query,
    "argmax_labels": argmax_labels,
    "confusion": confusion_query,
    "confusion_percent": confusion_percent_query,
    "confusion_totals": confusion_totals_query,
    "token_metrics": token_metrics_query,
    "class_report": class_report_query,
    "entity_metrics": entity_metrics_query,
    "entity_spans": entity_spans_query,
    "accepted_spans": accepted_spans_query,
    "filter_numeric": filter_numeric_query,
    "filter_apostrophe": filter_apostrophe_query,
    "dedup": dedup_query,
    "concat_splits": concat_splits_query,
    "split_sizes": split_sizes_query,
    "distribution": distribution_query,
    "review_blocks": review_blocks_query,
    "parse_corrections": parse_corrections_query,
    "apply_corrections": apply_corrections_query,
    "history_pairs": history_pairs_query,
    "best_epoch": best_epoch_query,
    "early_stop": early_stop_query,
    "parent_version": parent_version_query,
    "top_runs": top_runs_query,
    "natural_sort": natural_sort_query,
    "next_version": next_version_query,
    "model_dataset_match": model_dataset_match_query,
    "param_grid": param_grid_query,
    "config_overlay": config_overlay_query,
    "metrics_long": metrics_long_query,
    "annotate_corpus": annotate_corpus_query,
    "majority_tagger": majority_tagger_query,
    "logreg_tagger": logreg_tagger_query,
    "document_fix_tags": document_fix_tags_query,
    "document_class_report": document_class_report_query,
    "document_entity_metrics": document_entity_metrics_query,
    "document_words": document_words_query,
    "document_spans": document_spans_query,
    "annotation_mismatches": annotation_mismatches_query,
    "preset_configs": preset_configs_query,
    "sweep_trials": sweep_trials_query,
    "predict_spans": predict_spans_query,
    "modelling_dataset": modelling_dataset_query,
    "masked_accuracy": masked_accuracy_query,
    "correction_order": correction_order_query,
    "version_folder": version_folder_query,
    "compare_runs": compare_runs_query,
    "sorted_runs": sorted_runs_query,
    "generations": generations_query,
    "training_history": training_history_query,
    "evaluation_checks": evaluation_checks_query,
    "evaluate_models": evaluate_models_query,
    "parse_lists": parse_lists_query,
    "review_files": review_files_query,
    "history_merge": history_merge_query,
    "exact_split": exact_split_query,
    "entity_metrics_flat": entity_metrics_flat_query,
    "version_corpora": version_corpora_query,
    "sweep_rungs": sweep_rungs_query,
    "sequence_tagger": sequence_tagger_query,
    **IO_QUERIES,
}
