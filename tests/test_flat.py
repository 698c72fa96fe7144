"""Pieces, words and spans over flat arrays against plain Python, a piece at a time; one Arrow step for chained operators."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tagtable.constants import LABELS
from tagtable.functions.flat import cut_strings, in_slices, laid_out
from tagtable.operators.pieces import PIECES_TYPE, words_from_pieces
from tagtable.operators.spans import entity_spans, spans_from_pieces, token_offsets
from tagtable.sources import fixtures as fx

WORDS = ["a", "", "šťastný", "abcd", "abcde", "Ġx", "😀😀😀😀😀", "ľ", "12:30", "x" * 41]


def plain_pieces(key, tokens):
    out, pos = [], 0
    for k, t in enumerate(tokens):
        tag = None if key is None else (key * 7 + k * 13) % 14
        for c in range(max(-(-len(t) // 4), 1)):
            label = None if tag is None else LABELS[(tag + (c > 0)) % 14]
            out.append((label, ("Ġ" if k and not c else "") + t[4 * c:4 * c + 4], pos + 4 * c, pos + min(4 * c + 4, len(t))))
        pos += len(t) + 1
    return out


def plain_words(p):
    first = [i for i, x in enumerate(p) if i == 0 or (x[1] or "").startswith("Ġ")]
    return [(p[a][0], "".join(x[1] or "" for x in p[a:b]).removeprefix("Ġ"), p[a][2], p[b - 1][3], a, b - a) for a, b in zip(first, [*first[1:], len(p)])]


def plain_spans(p):
    kind = [x[0] and x[0].rsplit("-", 1)[-1] for x in p]
    cuts = [i for i in range(len(p)) if i == 0 or (kind[i] is not None and kind[i - 1] is not None and kind[i] != kind[i - 1])]
    return [(kind[a], p[i][2], p[b - 1][3], i, b - 1) for a, b in zip(cuts, [*cuts[1:], len(p)]) for i in range(a, b) if (p[i][0] or "").startswith("B")]


def plain_accepted(p):
    out, spans = [], plain_spans(p)
    marked = [(x[1] or "").startswith("Ġ") for x in p]
    for k, (kind, s, e, i, j) in enumerate(spans):
        if not ((i == 0 or marked[i]) and (j == len(p) - 1 or marked[j + 1])):
            continue
        _, ps, pe, _, _ = spans[k - 1]
        if not out or not (ps <= s < pe and ps <= e - 1 < pe):
            out.append((kind, s, e))
    return out


def tuples(rows):
    return None if rows is None else [tuple(x) for x in rows]


def test_pieces_words_and_spans_of_any_tokens(spark):
    rng = random.Random(1)
    rows = [(rng.choice([-5, 0, 7, 10**17, None]), [rng.choice(WORDS) for _ in range(rng.randrange(30))]) for _ in range(400)] + [(1, None), (2, [])]
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "n int, k long, t array<string>").repartition(3)
    p = df.select("n", fx.pieces("k", "t").alias("p"))
    got = p.select("n", "p", words_from_pieces("p").alias("w"), entity_spans("p").alias("s"), spans_from_pieces("p").alias("a")).collect()
    assert len(got) == len(rows)
    for r in got:
        key, tokens = rows[r.n]
        want = None if tokens is None else plain_pieces(key, tokens)
        assert tuples(r.p) == want
        assert tuples(r.w) == (None if want is None else plain_words(want))
        assert tuples(r.s) == plain_spans(want or []) and tuples(r.a) == plain_accepted(want or [])


def test_words_and_spans_of_any_pieces(spark):
    rng = random.Random(2)
    labels = ["0", "B-P", "I-P", "B-Q", "I-Q", "Time", "B-x-P", "B", None]
    rows = []
    for n in range(1500):
        cuts = sorted(rng.randrange(40) for _ in range(2 * rng.randrange(9)))
        rows.append((n, [(rng.choice(labels[:-1] if n % 3 else labels), rng.choice(["a", "Ġb", "Ġ", "", "ĠĠc", "č"] + [None] * (n % 5 == 0)), s, e)
                         for s, e in zip(cuts[::2], cuts[1::2])]))
    df = spark.createDataFrame([*rows, (1500, None)], f"n int, p {PIECES_TYPE}")
    for r in df.select("n", words_from_pieces("p").alias("w"), entity_spans("p").alias("s"), spans_from_pieces("p").alias("a")).collect():
        p = rows[r.n][1] if r.n < 1500 else []
        assert tuples(r.w) == (plain_words(p) if r.n < 1500 else None)
        assert tuples(r.s) == plain_spans(p) and tuples(r.a) == plain_accepted(p)


def test_offsets_after_a_null_token_are_null(spark):
    df = spark.createDataFrame([(["ab", None, "c"],), ([],), (None,), (["č", "", "d"],)], "t array<string>")
    assert [tuples(r.o) for r in df.select(token_offsets("t").alias("o")).collect()] == [[(0, 2), (3, None), (None, None)], [], [], [(0, 1), (2, 2), (3, 4)]]


def test_slices_of_a_batch_give_what_the_batch_gives():
    lists = pa.array([["ab", "č"], None, [], ["abcdefgh"] * 9, ["x"], []]).slice(1)

    def cut(rows):
        words, cuts = laid_out(rows)
        text, n, _ = cut_strings(words, 3)
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n))[cuts], pa.int32()), text)

    want = [[], [], ["abc", "def", "gh"] * 9, ["x"], []]
    assert all(in_slices(cut, lists, elements=k).to_pylist() == want for k in (1, 2, 9, 100)) and in_slices(cut, lists.slice(5)).to_pylist() == []


def test_pieces_of_a_document_never_leave_the_worker_that_finds_its_spans(spark):
    from tagtable.plans.queries import document_spans_query

    plan = document_spans_query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "spans(batch(" in plan


def test_flat_rows_with_unknown_tags_nulls_and_other_lengths(spark):
    from tagtable.operators import metrics as M

    rows = [(0, [3, 4], [3, 4]), (1, [None, 3, -100, 20], [None, 3, -100, 21, 0]), (2, None, [1]), (3, [], [])]
    df = spark.createDataFrame(rows, "id long, g array<int>, p array<int>")
    r = M.flat_entity_counts(df, "g", "p").first()
    # a chunk ends at the end of sentence 0; the start of sentence 1 is at its second place, and the tag after it ends nothing
    assert (r.n_gold, r.n_pred, r.n_tp, r.n_tok, r.n_eq) == (1, 1, 1, 6, 4)  # a sentence without gold tags counts nothing


def test_sentences_are_annotated_once_for_both_corpora(spark, monkeypatch):
    from tagtable.plans import queries as Q

    kept = []
    monkeypatch.setattr(Q, "stored", lambda df, name: kept.append(name) or df)
    Q.entity_metrics_flat_query(spark, "/root/testdata/sf0.001")
    assert kept == ["annotated"]


def test_batch_predictor_gives_the_pieces_of_the_plain_one(spark):
    from tagtable.operators import tagger as T

    rng = random.Random(3)
    texts = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(12))) for _ in range(300)] + [None, "", "  ", " a  b "]
    df = spark.createDataFrame([(n - 50, t) for n, t in enumerate(texts)], "id long, text string").repartition(3)
    got, want = (T.annotate(df, lambda f=f: f(shift=5), keep=["text"]) for f in (T.FixtureBatchPredictor, T.FixturePredictor))
    assert got.exceptAll(want).count() == 0 and got.count() == len(texts)
    tags = got.select("pieces", T.word_tags(words_from_pieces("pieces")).alias("t")).collect()
    assert all(r.t == [LABELS.index(w[0]) for w in plain_words(tuples(r.pieces))] for r in tags)


def test_word_tags_of_unknown_names_are_null(spark):
    from tagtable.operators import tagger as T

    df = spark.createDataFrame([([("B-Date", "a", 0, 1, 0, 1), ("x", "b", 2, 3, 1, 1), (None, "c", 4, 5, 2, 1)],), (None,), ([],)],
                               "w array<struct<entity:string,word:string,start:int,end:int,first_piece:int,n_pieces:int>>")
    assert [r.t for r in df.select(T.word_tags("w").alias("t")).collect()] == [[7, None, None], None, []]


def test_pieces_and_words_of_a_document_are_one_arrow_step(spark):
    from tagtable.plans.queries import document_words_query

    plan = document_words_query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("words(batch(") == 1


def test_documents_go_to_the_workers_in_small_batches(spark):
    from tagtable.plans.queries import document_words_query
    from tagtable.session import ARROW_BATCH_BYTES, small_arrow_batches

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "64m")
        document_words_query(spark, "/root/testdata/sf0.001")
        assert spark.conf.get(key) in (str(ARROW_BATCH_BYTES), f"{ARROW_BATCH_BYTES}b")
        spark.conf.set(key, "1m")
        small_arrow_batches(spark)
        assert spark.conf.get(key) in ("1m", f"{1 << 20}b")
    finally:
        spark.conf.set(key, before)
