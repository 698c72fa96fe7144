"""End-to-end pipelines a user calls (L1-L6), composed from the operators.
Each is one lineage: no intermediate files are written and read back."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtable.functions.arrays import computed_once
from tagtable.functions.labels import IGNORE_INDEX, PAD_TOKEN, pad_truncate
from tagtable.functions.normalize import normalize
from tagtable.functions.rules import fix_tags
from tagtable.functions.tokens import parse_int_repr, parse_list, repr_tokens_to_sentence, tokenize
from tagtable.operators import corrections as C
from tagtable.operators import datasets as D
from tagtable.operators import metrics as M
from tagtable.operators import runs as R
from tagtable.operators import tagger as T
from tagtable.operators.pieces import words_from_pieces
from tagtable.operators.spans import spans_from_pieces
from tagtable.sources.tables import first_rows


def annotate_corpus(sentences: DataFrame, predictor_factory: Callable, corrections: DataFrame | None = None,
                    apply_rules: bool = True, key: str = "id", limit: int | None = None) -> DataFrame:
    """Annotate raw sentences end to end (L1): take the first ``limit`` rows
    or all (O1), normalise, tokenise, run the predictor in Arrow batches, roll
    pieces up to words (first piece wins), correct tags with the lexicon
    rules, apply human corrections. Tokens come from the normalised sentence;
    the model gives tags only (its pieces may be spelt otherwise).
    Output ``id, tokens, lemmas, model_tags, fixed_tags``; no shuffle until
    the corrections join. See ``annotation_mismatches`` for rows whose
    numbers of words, tags or lemmas differ."""
    s = first_rows(sentences, limit, key).select(key, normalize("text").alias("text"), normalize("lemma_text").alias("lemma_text"))
    ann = T.annotate(s, predictor_factory, text="text", key=key, keep=["text", "lemma_text"])
    out = ann.select(key, tokenize("text").alias("tokens"), tokenize("lemma_text").alias("lemmas"),
                     T.word_tags(words_from_pieces("pieces")).alias("model_tags"))
    fixed = fix_tags("tokens", "lemmas", "model_tags") if apply_rules else F.col("model_tags")
    out = out.withColumn("fixed_tags", fixed)
    if corrections is not None:
        out = C.apply_corrections(out, corrections, key=key, tags="fixed_tags")
    return out


def annotation_mismatches(annotated: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose number of words differs from that of the tags or the lemmas
    (Q6, Q13), with the three numbers."""
    n = {c: F.size(c).alias(f"n_{c}") for c in ("tokens", "model_tags", "lemmas")}
    return annotated.select(key, *n.values()).filter(
        (F.col("n_tokens") != F.col("n_model_tags")) | (F.col("n_tokens") != F.col("n_lemmas")))


def predict_spans(sentences: DataFrame, predictor_factory: Callable, key: str = "id", text: str = "text",
                  normalise: bool = True) -> DataFrame:
    """Text in, accepted entity spans out (X2): ``id, type, start, end``, one
    row per span, offsets in the (normalised) text."""
    s = sentences.select(key, (normalize(text) if normalise else F.col(text)).alias("text"))
    ann = T.annotate(s, predictor_factory, text="text", key=key)
    return ann.select(key, F.inline_outer(spans_from_pieces("pieces"))).filter(F.col("type").isNotNull())


def score_annotated(df: DataFrame, gold: str = "fixed_tags", pred: str = "model_tags") -> dict[str, DataFrame]:
    """Score an annotated table (L1's last step, X5)."""
    return M.evaluate_all(df, gold, pred)


def test_split_repr(df: DataFrame, tokens: str = "tokens", tags: str = "ner_tags") -> DataFrame:
    """The saved test split in its list-repr text form (K5):
    ``['a' 'b']`` and ``[0 3]``."""
    return df.withColumns({
        "tokens_repr": F.concat(F.lit("["), F.array_join(
            F.transform(tokens, lambda t: F.concat(F.lit("'"), t, F.lit("'"))), " "), F.lit("]")),
        "ner_tags_repr": F.concat(F.lit("["), F.array_join(F.col(tags).cast("array<string>"), " "), F.lit("]")),
    })


def evaluate_models(test_rows: DataFrame, factory: Callable[[dict], Callable], params: Sequence[str],
                    model: str = "model", key: str = "id", tokens_repr: str = "tokens_repr",
                    tags_repr: str = "ner_tags_repr") -> DataFrame:
    """Score every model on its own test rows in one job (L3, L4). Rows carry
    the model they belong to and its parameters: parse the repr text (C3, C4),
    tag with that model (no rules, no corrections), zip gold and predicted per
    row and aggregate per model. The work is linear in the test rows."""
    t = test_rows.select(key, model, *params, repr_tokens_to_sentence(tokens_repr).alias("text"),
                         parse_int_repr(tags_repr).alias("gold"))
    ann = T.annotate_by_model(t, factory, params, model=model, key=key, keep=["gold"])
    scored = ann.select(key, model, "gold", T.word_tags(words_from_pieces("pieces")).alias("pred"))
    pairs = M.gold_pred_pairs(scored, "gold", "pred", keep=[model])
    return M.token_metrics(M.confusion_by(pairs, [model]), by=[model])


def training_history(records: DataFrame, patience: int | None = None) -> DataFrame:
    """History table (L6): step records merged pairwise, plus the best
    epoch per run and, with ``patience``, the early-stopping epoch."""
    pairs = R.history_pairs(R.keep_step_records(records))
    out = pairs.join(R.best_epoch(pairs), "run_id", "left")
    if patience is not None:
        out = out.join(R.early_stop(pairs, patience), "run_id", "left")
    return out


def compare_runs(runs: DataFrame, separate_generations: bool = True, k: int = 10) -> DataFrame:
    """Run comparison table (L5): generation per run, the (at most) k runs
    per generation with the lowest macro F1 (quirk Q16), in long form."""
    g = runs.withColumn("parent_version", R.parent_version("Name") if separate_generations else F.lit("best"))
    top = R.top_k_per_group(g, "parent_version", [F.col("`test/macro_f1`").asc(), R.natural_key("Name").asc()], k)
    return R.metrics_long(top, keep=["parent_version", "rank"])


def modelling_dataset(annotated: DataFrame, key: str = "id", tokens: str = "tokens", tags: str = "fixed_tags",
                      bucket: Column | None = None, max_length: int | None = None) -> DataFrame:
    """Modelling dataset from annotated rows (L2): list texts are parsed where
    the columns are strings (C5; see ``split_rejects`` for the rows that fail),
    columns renamed and cast (P2, P4), copies dropped (A8, the least key
    stays), rows split 64/16/20 (W6) and words and labels padded or cut
    together to ``max_length`` (C19). Output ``key, tokens, ner_tags, subset``."""
    kinds = dict(annotated.dtypes)
    parsed = annotated.select(
        F.col(key).alias("key"),
        (computed_once(parse_list(tokens)) if kinds[tokens] == "string" else F.col(tokens)).alias("text_tokens"),
        (computed_once(parse_list(tags, "bigint")) if kinds[tags] == "string" else F.col(tags)).alias("fixed_tags"))
    good = parsed.filter(F.col("text_tokens").isNotNull() & F.col("fixed_tags").isNotNull())
    rows = D.dedup(D.to_modelling(good), ["tokens", "ner_tags"], keep="key")
    out = D.assign_subset(rows, "key", bucket=bucket).select("key", "tokens", "ner_tags", "subset")
    if max_length is not None:
        out = out.withColumns({"tokens": pad_truncate("tokens", max_length, pad=F.lit(PAD_TOKEN)),
                               "ner_tags": pad_truncate("ner_tags", max_length, pad=F.lit(IGNORE_INDEX).cast("bigint"))})
    return out
