"""Inputs derived from the driver's tables (see FIXTURES.md).

Every fixture is a Spark plan over the given tables, so its work grows with
them. The same derivations are written in DuckDB SQL in
``tagtable.plans.oracle`` for the correctness check."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtable.constants import LABELS, NUM_LABELS
from tagtable.functions.arrays import computed_once
from tagtable.functions.flat import cut_strings, in_slices, ints, laid_out, records, row_starts, stacked
from tagtable.functions.normalize import normalize
from tagtable.functions.tokens import tokenize
from tagtable.operators.pieces import PIECES_TYPE, WORD_MARKER
from tagtable.operators.spans import joined_offsets
from tagtable.sources.tables import read_table, spread

MONTHS_GENITIVE = ("januára", "februára", "marca", "apríla", "mája", "júna",
                   "júla", "augusta", "septembra", "októbra", "novembra", "decembra")
MONTHS_LEMMA = ("január", "február", "marec", "apríl", "máj", "jún",
                "júl", "august", "september", "október", "november", "december")


def _month_case(names) -> str:
    return "case month(o_orderdate) " + " ".join(
        f"when {i + 1} then '{n}'" for i, n in enumerate(names)) + " end"


def _sentence_expr(intro: str, months, verb: str, company: str, currency: str) -> str:
    return (
        f"'{intro} ' || cast(year(o_orderdate) as string) || ' ' || cast(day(o_orderdate) as string) || '. ' || "
        f"{_month_case(months)} || "
        "' o ' || lpad(cast(mod(o_custkey,24) as string),2,'0') || ':' || lpad(cast(mod(o_orderkey,60) as string),2,'0') || "
        f"' {verb} NBS {company} Nova a. s. ' || cast(cast(floor(o_totalprice/1000) as bigint) as string) || ' ' || "
        "lpad(cast(mod(cast(floor(o_totalprice) as bigint),1000) as string),3,'0') || "
        f"' {currency} (' || cast(mod(o_custkey,11) as string) || ',' || cast(mod(o_orderkey,10) as string) || '%) [' || "
        "cast(mod(o_orderkey,7) as string) || '].'"
    )


# Runs unchanged in Spark SQL and DuckDB.
SENTENCES_SQL = (
    "SELECT o_orderkey AS id, "
    + _sentence_expr("V roku", MONTHS_GENITIVE, "zaplatila", "firme", "eur") + " AS text, "
    + _sentence_expr("v rok", MONTHS_LEMMA, "zaplatiť", "firma", "euro") + " AS lemma_text "
    + "FROM {orders}"
)


SENTENCES_PER_TASK = 50_000


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sentence table ``id, text, lemma_text`` built from ``orders``."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    return spark.sql(SENTENCES_SQL, orders=spread(orders, "o_orderkey", rows_per_task=SENTENCES_PER_TASK))


def tokenized_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised and tokenised sentences: ``id, tokens, lemmas``."""
    s = sentences(spark, sf_dir)
    return s.select(
        "id",
        computed_once(tokenize(normalize("text"))).alias("tokens"),
        computed_once(tokenize(normalize("lemma_text"))).alias("lemmas"),
    )


def predictor_tag(id_col: Column, idx: Column) -> Column:
    """The fixture predictor's tag for word ``idx``: integer arithmetic only."""
    return F.pmod(id_col * 7 + idx * 13, F.lit(NUM_LABELS)).cast("int")


def predictor_tags(id_col: Column | str, tokens: Column | str) -> Column:
    idc = F.col(id_col) if isinstance(id_col, str) else id_col
    toks = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.transform(toks, lambda t, i: predictor_tag(idc, i))


PIECE_WIDTH = 4


def cut_pieces(ids: pa.Array, rows: pa.Array, piece_width: int, shift: int = 0) -> pa.Array:
    """The pieces of rows of tokens, whose tags are those of the predictor and ``shift``."""
    words, cuts = laid_out(rows)
    text, n, chars = cut_strings(words, piece_width)
    base = np.repeat(joined_offsets(chars, cuts), n)
    k = np.arange(len(words)) - row_starts(cuts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    key = np.repeat(pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), np.diff(cuts))
    tag = np.repeat((key % NUM_LABELS * 7 + k * 13 + shift) % NUM_LABELS, n)
    nameless = np.repeat(np.repeat(pc.is_null(ids).to_numpy(zero_copy_only=False), np.diff(cuts)), n)
    entity = pa.array(LABELS).take(pa.array((tag + (nth > 0)) % NUM_LABELS, mask=nameless))
    word = pc.if_else(pa.array((nth == 0) & (np.repeat(k, n) > 0)), pc.binary_join_element_wise(WORD_MARKER, text, ""), text)
    end = base + np.minimum((nth + 1) * piece_width, np.repeat(chars, n))
    return stacked(records(entity=entity, word=word, start=ints(base + nth * piece_width), end=ints(end)), np.append(0, np.cumsum(n))[cuts], rows)


def pieces(id_col: Column | str, tokens: Column | str, piece_width: int = PIECE_WIDTH) -> Column:
    """Sub-word pieces as a model pipeline returns them:
    ``array<struct<entity, word, start, end>>``. Each token is cut into
    ``piece_width``-character chunks; the first chunk of every token but the
    first carries the word-start marker 'Ġ'; the first chunk's entity is the
    predictor tag, later chunks get the next label (to prove the first wins)."""
    idc = F.col(id_col) if isinstance(id_col, str) else id_col
    toks = F.col(tokens) if isinstance(tokens, str) else tokens

    def batch(ids: pa.Array, rows: pa.Array) -> pa.Array:
        return in_slices(lambda i, r: cut_pieces(i, r, piece_width), ids, rows)

    return F.arrow_udf(batch, PIECES_TYPE)(idc.cast("bigint"), toks)


def subset_of(key: Column | str) -> Column:
    """Deterministic 64/16/20 split bucket used by the fixtures."""
    k = F.col(key) if isinstance(key, str) else key
    b = F.pmod(k, F.lit(25))
    return F.when(b < 16, "train").when(b < 20, "validation").otherwise("test")


def annotated_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, tokens, lemmas, model_tags, fixed_tags`` with the fixture
    predictor and the correction rules applied (sentence form)."""
    from tagtable.functions.rules import fix_tags

    t = tokenized_sentences(spark, sf_dir)
    t = t.withColumn("model_tags", predictor_tags("id", "tokens"))
    return t.withColumn("fixed_tags", fix_tags("tokens", "lemmas", "model_tags"))


def external_corpus(spark: SparkSession, sf_dir: str, subset: str | None = None) -> DataFrame:
    """With ``subset`` only that part, chosen before any text is read. A labelled external corpus from ``documents``: the whole normalised
    text, tokenised; ``2020`` appended where doc_id % 7 = 0 and ``d'Or``
    where doc_id % 10 = 0; tags from the tokens only, so copies stay copies."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    docs = spread(docs if subset is None else docs.filter(subset_of("doc_id") == subset), "doc_id")
    base = docs.select("doc_id", computed_once(tokenize(normalize("text"))).alias("t0"))
    t0 = F.col("t0")
    toks = F.concat(
        t0,
        F.when(F.pmod("doc_id", F.lit(7)) == 0, F.array(F.lit("2020"))).otherwise(F.array().cast("array<string>")),
        F.when(F.pmod("doc_id", F.lit(10)) == 0, F.array(F.lit("d'Or"))).otherwise(F.array().cast("array<string>")),
    )
    out = base.select("doc_id", computed_once(toks).alias("tokens"))
    tags = F.transform("tokens", lambda t, i: F.pmod(i + F.length(t), F.lit(7)).cast("bigint"))
    return out.select("doc_id", "tokens", tags.alias("ner_tags"), subset_of("doc_id").alias("subset"))


TRIGGERS = ("2020", "12:30", "NBS", "január", "25", "euro", "%", "rok", "1.5", "mil", "+3", "percento")


def annotated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as sentences of very different length: ``id, tokens,
    lemmas, model_tags, fixed_tags``. Every fourth word is one that a rule
    looks for, every seventh lemma a month; a third of the rows has a lemma
    less than words and a third one more; every 50th row is empty."""
    from tagtable.functions.rules import fix_tags

    docs = spread(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), "doc_id")
    base = docs.select(F.col("doc_id").alias("id"), computed_once(tokenize(normalize("text"))).alias("t0"))
    words = F.array(*[F.lit(w) for w in TRIGGERS])
    toks = F.transform("t0", lambda t, i: F.when(F.pmod(i + F.col("id"), F.lit(4)) == 0, F.get(words, F.pmod(i * 5 + F.col("id"), F.lit(len(TRIGGERS))).cast("int"))).otherwise(t))
    none = F.array().cast("array<string>")
    t = base.select("id", computed_once(F.when(F.pmod("id", F.lit(50)) == 0, none).otherwise(toks)).alias("tokens"))
    same = F.transform("tokens", lambda t, i: F.when(F.pmod(i + F.col("id"), F.lit(7)) == 0, F.lit("január")).otherwise(t))
    t = t.withColumn("l0", computed_once(same))
    lemmas = (F.when(F.pmod("id", F.lit(3)) == 0, F.slice("l0", 1, F.greatest(F.size("l0") - 1, F.lit(0))))
              .when(F.pmod("id", F.lit(3)) == 2, F.concat("l0", F.array(F.lit("rok")))).otherwise(F.col("l0")))
    t = t.select("id", "tokens", computed_once(lemmas).alias("lemmas"))
    t = t.withColumn("model_tags", predictor_tags("id", "tokens"))
    return t.withColumn("fixed_tags", fix_tags("tokens", "lemmas", "model_tags"))


# -- training runs from ``events`` ---------------------------------------------
TRAIN_EVENTS = ("view", "click")
EVAL_EVENTS = ("signup", "purchase")
SUMMARY_EVENT = "error"
NAME_PREFIX = "SlovakBERT_NER_Model_V"


def history_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training-log records, one per event: run = user, record order =
    event_id. view/click are training records (``loss``), signup/purchase
    evaluations (``eval_loss``, ``eval_f1``), error a summary (``train_loss``)."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "value"])
    t, v = F.col("event_type"), F.col("value")
    return ev.select(
        F.col("user_id").alias("run_id"), "event_id",
        F.when(t.isin(*TRAIN_EVENTS), v).alias("loss"),
        F.when(t.isin(*EVAL_EVENTS), v).alias("eval_loss"),
        F.when(t.isin(*EVAL_EVENTS), v / (F.abs(v) + 1)).alias("eval_f1"),
        F.when(t == SUMMARY_EVENT, v).alias("train_loss"),
    )


def run_name(user_id: Column) -> Column:
    version = F.when(F.pmod(user_id, F.lit(10)) == 0, F.lit("_POC")).otherwise(
        F.concat(F.lit("0.0."), (F.pmod(user_id, F.lit(6)) + 1).cast("string")))
    seq = F.when(F.pmod(user_id, F.lit(10)) == 0, F.floor(user_id / 10) + 1).otherwise(F.floor(user_id / 6) + 1)
    return F.concat(F.lit(NAME_PREFIX), version, F.lit("."), seq.cast("string"))


def run_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per run (user): name, a few hyperparameters and the metric
    columns, all exact ratios of event counts."""
    ev = read_table(spark, sf_dir, "events", ["user_id", "event_type"])

    def n_of(kind: str) -> Column:
        return F.sum(F.when(F.col("event_type") == kind, 1).otherwise(0))

    g = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), n_of("view").alias("nv"), n_of("click").alias("nc"),
                                  n_of("signup").alias("ns"), n_of("purchase").alias("np"),
                                  n_of("error").alias("ne"))
    n = F.col("n")
    r = lambda e: F.round(e, 6)
    return g.select(
        F.col("user_id").alias("run_id"),
        run_name(F.col("user_id")).alias("Name"),
        (F.lit(5e-05) * (F.pmod("user_id", F.lit(3)) + 1)).alias("learning_rate"),
        (F.pmod("user_id", F.lit(6)) + 10).alias("num_train_epochs"),
        r(F.col("nc") / n).alias("eval/precision"), r(F.col("nv") / n).alias("eval/recall"),
        r((F.col("nc") + F.col("nv")) / (n * 2)).alias("eval/f1"), r(1 - F.col("ne") / n).alias("eval/accuracy"),
        r(F.col("ns") / n).alias("test/precision"), r(F.col("np") / n).alias("test/recall"),
        r((F.col("ns") + F.col("np")) / (n * 2)).alias("test/f1"), r((n - F.col("ne")) / n).alias("test/accuracy"),
        r(F.col("nv") / (n + 1)).alias("test/macro_precision"), r(F.col("nc") / (n + 1)).alias("test/macro_recall"),
        r((F.col("nv") + F.col("nc") + F.col("ns")) / (n * 3)).alias("test/macro_f1"),
    )


def test_files(runs: DataFrame) -> DataFrame:
    """Test-file names for runs: exact copies of the name, names cut by two
    characters, and runs without a file."""
    u, name = F.pmod(F.col("run_id"), F.lit(4)), F.col("Name")
    f = (F.when(u == 0, F.concat(F.lit("test_dataset_"), name, F.lit(".csv")))
         .when(u == 1, F.concat(F.lit("test_dataset_"), F.expr("substring(Name, 1, length(Name) - 2)"),
                                F.lit("_old.csv")))
         .when(u == 3, F.concat(F.lit("test_"), name, F.lit("_v2.csv"))))
    return runs.select(f.alias("file")).filter(F.col("file").isNotNull())
