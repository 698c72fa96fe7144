"""Label arithmetic, pieces to words, spans."""
from pyspark.sql import functions as F

from tagtable.functions.labels import align_labels, argmax, pad_truncate
from tagtable.operators.pieces import piece_word_ids, words_from_piece_rows, words_from_pieces
from tagtable.operators.spans import entity_spans, spans_from_pieces


def test_align_labels(spark):
    df = spark.createDataFrame([([None, 0, 0, 1, None], [3, 4])], "w array<int>, l array<int>")
    r = df.select(align_labels("w", "l").alias("a"), align_labels("w", "l", False).alias("b")).first()
    assert r.a == [-100, 3, 3, 4, -100]
    assert r.b == [-100, 3, -100, 4, -100]


def test_argmax_first_on_ties_and_padding(spark):
    df = spark.createDataFrame([([0.1, 0.9, 0.9, 0.2], [1, 2])], "v array<double>, t array<int>")
    r = df.select(argmax("v").alias("a"), pad_truncate("t", 4).alias("p"), pad_truncate("t", 1).alias("q")).first()
    assert r.a == 1 and r.p == [1, 2, -100, -100] and r.q == [1]


def _pieces(spark, items):
    return spark.createDataFrame([(items,)], "p array<struct<entity:string,word:string,start:int,end:int>>")


def test_first_piece_wins(spark):
    df = _pieces(spark, [("B-Date", "ro", 0, 2), ("I-Date", "ku", 2, 4), ("0", "Ġ19", 5, 7), ("B-Date", "98", 7, 9)])
    w = df.select(words_from_pieces("p").alias("w"), piece_word_ids("p").alias("ids")).first()
    assert [x.entity for x in w.w] == ["B-Date", "0"]
    assert [x.word for x in w.w] == ["roku", "19 98".replace(" ", "")]
    assert [(x.start, x.end) for x in w.w] == [(0, 4), (5, 9)]
    assert w.ids == [None, 0, 0, 1, 1, None]


def test_piece_rows_variant_matches(spark):
    rows = spark.createDataFrame(
        [(1, 0, "ro", "B-Date", 0, 2), (1, 1, "ku", "I-Date", 2, 4), (1, 2, "Ġ19", "0", 5, 7)],
        "id long, idx int, word string, entity string, start int, end int")
    out = words_from_piece_rows(rows).orderBy("word_idx").collect()
    assert [(r.entity, r.start, r.end) for r in out] == [("B-Date", 0, 4), ("0", 5, 7)]


def test_span_cases(spark):
    def spans(labels):
        items = [(lab, ("Ġ" if i else "") + "w", i * 2, i * 2 + 1) for i, lab in enumerate(labels)]
        r = _pieces(spark, items).select(entity_spans("p").alias("s"), spans_from_pieces("p").alias("a")).first()
        return [(s.type, s.start, s.end) for s in r.s], [(s.type, s.start, s.end) for s in r.a]

    assert spans(["B-P", "I-P"]) == ([("P", 0, 3)], [("P", 0, 3)])
    # B-X B-X: the second opens an inner span (Q17) that the overlap rule drops
    assert spans(["B-P", "B-P"]) == ([("P", 0, 3), ("P", 2, 3)], [("P", 0, 3)])
    assert spans(["B-P", "I-D"]) == ([("P", 0, 1)], [("P", 0, 1)])
    assert spans(["Time"]) == ([], [])  # Q18


def test_off_boundary_span_then_contained(spark):
    # piece 1 continues word 0, so a span opening there is off the token boundary
    items = [("0", "ab", 0, 2), ("B-P", "cd", 2, 4), ("B-P", "Ġef", 5, 7), ("I-P", "Ġgh", 8, 10)]
    r = _pieces(spark, items).select(spans_from_pieces("p").alias("a")).first()
    assert [(s.start, s.end) for s in r.a] == [(5, 10)]
