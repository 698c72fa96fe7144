"""Language identification by error-correcting output codes.

Each learned language has a codeword of bits; each bit has a binary classifier over hashed byte trigrams that says on
which side of the bit a text lies: a naive Bayes log odds between the two groups of languages, each language weighing
the same. With up to five languages the code is exhaustive (every split into two groups), beyond that it has 31
columns drawn by a fixed generator. A margin is the mean log odds of a text's trigrams, in units of a typical one (below). A text
goes to the codeword with the least loss, log(1 + exp(-margin)) summed over the bits. The score is the winner's share of exp(-loss).

A text is ambiguous when the runner-up's loss is too near the winner's, as in texts of two languages, or when its trigrams are too
unlikely in the winner's language, as in texts of none. Both limits, and the unit of the margins, are set on training documents
that the classifiers are fitted without (one in ``CALIBRATION``, by a hash; the final classifiers have all): a typical margin is
``TYPICAL``; the least gap is half the median gap, the least mean log probability lies halfway from the median to that of trigrams drawn without regard to
language, and neither is above the value that a share of ``REJECTED`` of the rightly told documents falls short of. Fewer than ``ENOUGH``
such documents say nothing about either limit: then only equal losses are ambiguous.

Learning counts trigrams of every training text (documents whose crc32(doc_id as text) modulo 4 is not 2, with a
language). Counts are summed by task and then by (language, feature), so no language gathers in one task; only the counts of
``LANGUAGES`` x features reach the driver: of more languages the most frequent are learned (ties in code point order). lang, source and
doc_id are never read when predicting.

Trigrams are taken around each letter (a byte a-z after lowering, or any byte beyond ASCII), other bytes are blanks. A
null text, or one without a letter, is ``und`` with score 0 and ambiguous; so is every text if nothing was learned. Ties go
to the language first in code point order. Rows repeated in full get equal results. A null doc_id counts as ''. Extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtable.llm.common import read_table, slices, text_buffer

FOLDS, HELD_OUT = 4, 2
FEATURES_LOG2 = 14
COLUMNS, EXHAUSTIVE = 31, 5
LANGUAGES = 256
CALIBRATION, REJECTED, TYPICAL, ENOUGH = 8, 0.0025, 4.0, 30
NO_LANGUAGE = "und"

FOLD_BYTE = np.zeros(256, np.uint8) + 0x20
FOLD_BYTE[0x61:0x7B] = np.arange(0x61, 0x7B)
FOLD_BYTE[0x41:0x5B] = np.arange(0x61, 0x7B)
FOLD_BYTE[0x80:] = np.arange(0x80, 0x100)


def held_out(doc_id: Column, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds)) == fold


def trigrams(texts):
    """For slices of documents: (first document, hashed trigram of each letter, edges between documents, documents
    that have a letter a-z)."""
    data, off = text_buffer(texts)
    for i, j in slices(off):
        b, o = FOLD_BYTE[data[off[i] : off[j]]], off[i : j + 1] - off[i]
        before, after = np.full(len(b), 0x20, np.uint8), np.full(len(b), 0x20, np.uint8)
        before[1:], after[:-1] = b[:-1], b[1:]
        inner = o[(o > 0) & (o < len(b))]
        before[inner], after[inner - 1] = 0x20, 0x20
        at = np.flatnonzero(b != 0x20)
        code = before[at].astype(np.uint32) << np.uint32(16) | b[at].astype(np.uint32) << np.uint32(8) | after[at]
        edge, plain = np.searchsorted(at, o), np.concatenate(([0], np.cumsum(b[at] < 0x80)))
        yield i, (code * np.uint32(2654435761) >> np.uint32(32 - FEATURES_LOG2)).astype(np.int32), edge, np.diff(plain[edge]) > 0


def _count(batches):
    """Trigram counts by language, those of the calibration part apart."""
    total: dict[tuple[str, int], np.ndarray] = {}
    for batch in batches:
        langs = batch["lang"].dictionary_encode()
        names, which = langs.dictionary.to_pylist(), 2 * langs.indices.to_numpy().astype(np.int64) + batch["apart"].to_numpy(zero_copy_only=False)
        for i, f, edge, _ in trigrams(batch["text"]):
            own = np.repeat(which[i : i + len(edge) - 1], np.diff(edge))
            counts = np.bincount((own << FEATURES_LOG2) + f, minlength=2 * len(names) << FEATURES_LOG2).reshape(2 * len(names), -1)
            for k in np.flatnonzero(counts.any(1)).tolist():
                total[names[k // 2], k % 2] = total.get((names[k // 2], k % 2), 0) + counts[k]
    for (name, apart), c in total.items():
        at = np.flatnonzero(c)
        yield pa.record_batch({"lang": pa.array([name] * len(at), pa.string()), "apart": pa.array([bool(apart)] * len(at)), "feature": pa.array(at.astype(np.int32)), "n": pa.array(c[at])})


def codewords(n: int) -> np.ndarray:
    """Rows of +1 and -1, one for each language."""
    if n <= EXHAUSTIVE:  # the first language is always +1; all splits but the one with all on its side
        bits = np.array([[1] + [1 if s >> k & 1 else -1 for k in range(n - 1)] for s in range(max(1, 2 ** (n - 1) - 1))]).T
        return bits if n > 1 else np.ones((n, 1), int)
    rng, best, gap = np.random.default_rng(n), None, -1
    for _ in range(200):
        c = rng.integers(0, 2, (n, COLUMNS)) * 2 - 1
        far = ((COLUMNS - c @ c.T) // 2 + np.eye(n, dtype=int) * COLUMNS).min()
        split = (abs(c.sum(0)) < n).all()
        if split and far > gap:
            best, gap = c, far
    return best


class Model(NamedTuple):
    names: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # bits x features
    likely: np.ndarray  # languages x features: log probabilities
    unit: float = 1.0  # of a margin
    gap: float = 0.0  # losses nearer than this are ambiguous
    least: float = -np.inf  # texts whose trigrams are less likely than this are like none


def fit(names: list[str], counts: np.ndarray) -> Model:
    p = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True)
    code = codewords(len(names))
    weights = np.zeros((code.shape[1], counts.shape[1]), np.float32)
    for b in range(code.shape[1] if len(names) > 1 else 0):
        weights[b] = np.log(p[code[:, b] > 0].mean(0)) - np.log(p[code[:, b] < 0].mean(0))
    return Model(names, code, weights, np.log(p).astype(np.float32))


def learn(docs: DataFrame) -> Model:
    """From rows with text and lang."""
    apart = F.pmod(F.xxhash64("doc_id", "text"), F.lit(CALIBRATION)) == 0
    rows = docs.where("lang is not null and text is not null").select("lang", "text", apart.alias("apart"))
    names = [r["lang"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()]
    names.sort(key=lambda s: s.encode())
    if not names:
        return fit([], np.zeros((0, 1 << FEATURES_LOG2)))
    rows = rows.where(F.col("lang").isin(names))
    found = (rows.mapInArrow(_count, "lang string, apart boolean, feature int, n long")
             .groupBy("lang", "apart", "feature").agg(F.sum("n").alias("n")).toPandas())  # LANGUAGES x 2 x features at most
    counts = np.zeros((2, len(names), 1 << FEATURES_LOG2))
    counts[found["apart"].to_numpy(dtype=int), found["lang"].map({x: i for i, x in enumerate(names)}).to_numpy(dtype=int), found["feature"].to_numpy(dtype=int)] = found["n"].to_numpy()
    return calibrated(fit(names, counts.sum(0)), rows.where("apart"), fit(names, counts[0]))


def calibrated(model: Model, apart: DataFrame, without: Model) -> Model:
    """``model`` with its unit and limits, from how ``without``, fitted without the rows ``apart``, judges them."""
    shared = apart.sparkSession.sparkContext.broadcast(without)

    def judge(unit: float):
        def run(batches):
            m = shared.value._replace(unit=unit)
            for batch in batches:
                size, who, _, gap, like = judged(batch["text"], m)[:5]
                right = np.array([x is not None and m.names[k] == x for x, k in zip(batch["lang"].to_pylist(), who.tolist())], bool) & (size > 0)
                yield pa.record_batch({"right": pa.array(right), "margin": pa.array(typical(batch["text"], m)), "gap": pa.array(gap), "like": pa.array(like)})

        return apart.select("text", "lang").mapInArrow(run, "right boolean, margin double, gap double, like double").where("right")

    low = [REJECTED, 0.5]
    unit, right = judge(1.0).agg(F.percentile_approx("margin", 0.5, 10_000), F.count("*")).first()
    if right < ENOUGH or not unit:
        return model
    unit = float(unit) / TYPICAL
    gaps, likes = judge(unit).agg(F.percentile_approx("gap", low, 10_000), F.percentile_approx("like", low, 10_000)).first()
    noise = float(model.likely.mean(1).max())
    return model._replace(unit=unit, gap=min(gaps[0], gaps[1] / 2), least=min(likes[0], (likes[1] + noise) / 2))


def decode(margins: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Winner, score and gap to the runner-up's loss of each row of margins."""
    loss = np.logaddexp(0, -margins[:, None, :] * code[None]).sum(2)
    order = np.argsort(loss, axis=1, kind="stable")
    best = np.take_along_axis(loss, order[:, :1], 1)
    score = 1 / np.exp(best - loss).sum(1)
    gap = np.take_along_axis(loss, order[:, 1:2], 1)[:, 0] - best[:, 0] if code.shape[0] > 1 else np.full(len(loss), np.inf)
    return order[:, 0], score, gap


def _margins(texts, model: Model):
    """For slices of documents: (first document, margins, number of trigrams, trigrams, edges, documents with a letter a-z)."""
    for i, f, edge, plain in trigrams(texts):
        m = np.diff(edge)
        full = np.flatnonzero(m)
        margins = np.zeros((len(m), len(model.weights)))
        if len(full):
            for b, w in enumerate(model.weights):
                margins[full, b] = np.add.reduceat(w[f], edge[full]) / m[full] / model.unit
        yield i, margins, m, f, edge, plain


def typical(texts, model: Model) -> np.ndarray:
    out = np.zeros(len(texts))
    for i, margins, *_ in _margins(texts, model):
        out[i : i + len(margins)] = np.median(np.abs(margins), axis=1)
    return out


def judged(texts, model: Model):
    """Number of trigrams, winner, score, gap, mean log probability in the winner's language, and whether a letter a-z is there."""
    n = len(texts)
    size, who, score, gap, like, letter = np.zeros(n, int), np.zeros(n, int), np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n, bool)
    for i, margins, m, f, edge, plain in _margins(texts, model):
        at = slice(i, i + len(m))
        size[at], letter[at] = m, plain
        who[at], score[at], gap[at] = decode(margins, model.code)
        full = np.flatnonzero(m)
        if len(full):
            like[i + full] = np.add.reduceat(model.likely[np.repeat(who[at], m), f].astype(np.float64), edge[full]) / m[full]
    return size, who, score, gap, like, letter


def _predict(docs: DataFrame, model: Model, kept: list[str]) -> DataFrame:
    """The kept columns by number (c0, c1, ...), lang_pred, score and ambiguous."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # (bits + languages) x features, whatever the input
    text = f"c{kept.index('text')}" if "text" in kept else "text"

    def run(batches):
        m = shared.value
        for batch in batches:
            n, texts = batch.num_rows, batch[text]
            none, unsure, who, score = np.ones(n, bool), np.ones(n, bool), np.zeros(n, int), np.zeros(n)
            if m.names:
                size, who, score, gap, like, letter = judged(texts, m)
                none = ~letter
                for d in np.flatnonzero(none & (size > 0)).tolist():  # bytes beyond ASCII may all be marks
                    none[d] = not any(c.isalpha() for c in texts[d].as_py())
                unsure = (gap < m.gap) | (gap == 0) | (like < m.least)
            pred = [NO_LANGUAGE if x else m.names[k] for x, k in zip(none.tolist(), who.tolist())]
            yield pa.record_batch({**{f"c{k}": batch[f"c{k}"] for k in range(len(kept))}, "lang_pred": pa.array(pred, pa.string()),
                                   "score": pa.array(np.where(none, 0.0, score)), "ambiguous": pa.array(none | unsure)})

    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept)], *([] if "text" in kept else ["text"]))
    fields = "".join(f"c{k} {docs.schema[c].dataType.simpleString()}, " for k, c in enumerate(kept))
    return plain.mapInArrow(run, f"{fields}lang_pred string, score double, ambiguous boolean")


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` but text, with lang_pred, score and ambiguous (which replace columns of these names)."""
    kept = [c for c in docs.columns if c not in ("text", "lang_pred", "score", "ambiguous")]
    return _predict(docs, model, kept).select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(kept)], "lang_pred", "score", "ambiguous")


def keep_identified(docs: DataFrame, learn_from: DataFrame) -> DataFrame:
    """The documents whose language is told apart without doubt; the rest (``und`` or ambiguous) is rejected."""
    names = docs.columns
    return _predict(docs, learn(learn_from), names).where("NOT ambiguous").select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)])


def op9(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), model)
