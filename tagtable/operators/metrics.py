"""Token- and entity-level scoring.

Per-sentence work stays in the sentence row; the only shuffles are partial
aggregates whose keys are bounded by the label set (at most 14 x 14 keys),
so map-side combining shrinks every task to a handful of rows before the
exchange, however the tokens are skewed."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtable.constants import LABELS, NUM_LABELS
from tagtable.functions.arrays import computed_once, let
from tagtable.functions.flat import flags, in_slices, ints, laid_out, records, stacked
from tagtable.operators.positions import chunk_max, chunked
from tagtable.session import cut_lineage

ROUND = 6


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _div(a: Column, b: Column) -> Column:
    """0/0 and x/0 give 0, as the scoring library's zero-division default."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def gold_pred_pairs(df: DataFrame, gold: str, pred: str, keep: Sequence[str] = ()) -> DataFrame:
    """Positional zip of gold and predicted tags per row (J7). Rows whose
    lengths differ are not shifted into their neighbours (quirk Q13): the
    extra positions carry a null on one side and are dropped here; count them
    with :func:`length_mismatches`."""
    z = F.arrays_zip(F.col(gold).alias("gold"), F.col(pred).alias("pred"))
    return (
        df.select(*keep, F.explode_outer(z).alias("z"))
        .select(*keep, F.col("z.gold").alias("gold"), F.col("z.pred").alias("pred"))
        .filter(F.col("gold").isNotNull() & F.col("pred").isNotNull())
    )


def length_mismatches(df: DataFrame, gold: str, pred: str, key: str = "id") -> DataFrame:
    return df.filter(F.size(gold) != F.size(pred)).select(
        key, F.size(gold).alias("n_gold"), F.size(pred).alias("n_pred"))


def label_grid(spark: SparkSession, n: int = NUM_LABELS) -> DataFrame:
    """All (gold, pred) label pairs: n*n rows generated from a range."""
    return spark.range(n * n).select(
        (F.col("id") / n).cast("int").alias("gold"), (F.col("id") % n).cast("int").alias("pred"))


def confusion(pairs: DataFrame, n_labels: int = NUM_LABELS) -> DataFrame:
    """Confusion counts ``gold, pred, n`` completed to every label pair with
    zeros (A3; quirk Q14). The count is a partial aggregate; the grid is at
    most n_labels^2 rows, so joining it costs nothing."""
    counts = pairs.groupBy("gold", "pred").agg(F.count("*").alias("n"))
    grid = label_grid(pairs.sparkSession, n_labels)
    return grid.join(F.broadcast(counts), ["gold", "pred"], "left").select(
        "gold", "pred", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def confusion_percent(conf: DataFrame) -> DataFrame:
    """Row share of each cell: n / row total; null for an empty row (A4)."""
    from pyspark.sql import Window

    tot = F.sum("n").over(Window.partitionBy("gold"))
    return conf.select("gold", "pred", "n",
                       F.round(F.try_divide(F.col("n"), tot), ROUND).alias("pct"))


def confusion_totals(conf: DataFrame) -> DataFrame:
    """Cell counts plus row, column and grand totals via ``cube`` (A4);
    totals are labelled 'TOTAL'."""
    g = conf.cube("gold", "pred").agg(F.sum("n").cast("bigint").alias("n"),
                                       F.grouping("gold").alias("gg"), F.grouping("pred").alias("gp"))
    lab = F.array(*[F.lit(x) for x in LABELS])
    return g.select(
        F.when(F.col("gg") == 1, F.lit("TOTAL")).otherwise(F.get(lab, F.col("gold"))).alias("gold_label"),
        F.when(F.col("gp") == 1, F.lit("TOTAL")).otherwise(F.get(lab, F.col("pred"))).alias("pred_label"),
        "n",
    )


def confusion_by(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Confusion counts per group (e.g. per model) without zero cells:
    ``by.., gold, pred, n``. Scoring needs no zeros."""
    return pairs.groupBy(*by, "gold", "pred").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def per_class(conf: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """tp, support, predicted, precision, recall, F1 per label that occurs in
    gold or predictions (A5/A6 building block), per ``by`` group."""
    by = list(by)
    sup = conf.groupBy(*by, F.col("gold").alias("label")).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col("gold") == F.col("pred"), F.col("n")).otherwise(0)).alias("tp"))
    prd = conf.groupBy(*by, F.col("pred").alias("label")).agg(F.sum("n").alias("predicted"))
    c = sup.join(prd, [*by, "label"], "full_outer").fillna(0, ["support", "tp", "predicted"])
    c = c.filter((F.col("support") > 0) | (F.col("predicted") > 0))
    p = _div(F.col("tp"), F.col("predicted"))
    r = _div(F.col("tp"), F.col("support"))
    return c.select(*by, "label", "tp", "support", "predicted",
                    p.alias("precision"), r.alias("recall"), _div(2 * p * r, p + r).alias("f1"))


def token_metrics(conf: DataFrame, name: str | Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One metrics row (per ``by`` group): weighted and macro
    precision/recall/F1 and accuracy (A5, K2). Macro is the plain mean over
    labels seen in gold or predictions; weighted uses the gold support."""
    pc = per_class(conf, by)
    tot = F.sum("support")
    out = pc.groupBy(*by).agg(
        F.round(F.sum(F.col("precision") * F.col("support")) / tot, ROUND).alias("test/precision"),
        F.round(F.avg("precision"), ROUND).alias("test/macro_precision"),
        F.round(F.sum(F.col("recall") * F.col("support")) / tot, ROUND).alias("test/recall"),
        F.round(F.avg("recall"), ROUND).alias("test/macro_recall"),
        F.round(F.sum(F.col("f1") * F.col("support")) / tot, ROUND).alias("test/f1"),
        F.round(F.avg("f1"), ROUND).alias("test/macro_f1"),
        F.round(F.sum("tp") / tot, ROUND).alias("test/accuracy"),
    )
    if name is not None:
        out = out.select((F.lit(name) if isinstance(name, str) else name).alias("Name"), "*")
    return out


def class_report(conf: DataFrame) -> DataFrame:
    """Per-label precision/recall/F1/support plus the accuracy, macro and
    weighted rows (A6, K3). Accuracy has only F1 and support, as the report."""
    pc = per_class(conf)
    lab = F.array(*[F.lit(x) for x in LABELS])
    rows = pc.select(F.get(lab, F.col("label")).alias("label"),
                     F.round("precision", ROUND).alias("precision"), F.round("recall", ROUND).alias("recall"),
                     F.round("f1", ROUND).alias("f1"), F.col("support").cast("bigint").alias("support"))
    tot = F.sum("support")
    summ = pc.agg(
        F.round(F.sum("tp") / tot, ROUND).alias("acc"),
        F.round(F.avg("precision"), ROUND).alias("mp"), F.round(F.avg("recall"), ROUND).alias("mr"),
        F.round(F.avg("f1"), ROUND).alias("mf"),
        F.round(F.sum(F.col("precision") * F.col("support")) / tot, ROUND).alias("wp"),
        F.round(F.sum(F.col("recall") * F.col("support")) / tot, ROUND).alias("wr"),
        F.round(F.sum(F.col("f1") * F.col("support")) / tot, ROUND).alias("wf"),
        tot.cast("bigint").alias("n"),
    )
    summary = summ.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), F.col("acc").alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), F.col("wp").alias("precision"),
                 F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("n").alias("support")),
    )))
    return rows.unionByName(summary)


# ---------------------------------------------------------------------------
# Entity level
# ---------------------------------------------------------------------------
CHUNK_TYPE = "struct<type:string,start:int,end:int>"


def _prefix(x: Column) -> Column:
    return F.substring(x, 1, 1)


def _etype(x: Column) -> Column:
    """Text after the first '-' of the label minus its first character; '_' if empty."""
    rest = F.split(F.substring(x, 2, 1 << 30), "-", 2)
    t = F.get(rest, F.size(rest) - 1)
    return F.when((t.isNull()) | (t == ""), F.lit("_")).otherwise(t)


def chunks(labels: Column | str, outside: Sequence[str] = ("O",), attrs_col: Column | None = None) -> Column:
    """Entity chunks of one labelled sequence: ``array<struct<type,start,end>>``
    (token indices, end inclusive).

    A chunk starts at a non-outside label that is first in the sentence, or
    follows an outside label, or has prefix B/S, or follows an E/S label, or
    has another type than the label before; it runs until the next start or
    outside label. With the default ``outside=('O',)`` the digit label '0'
    forms chunks of type '_' (quirk Q19); pass ``('O', '0')`` to treat it as
    outside."""
    out = list(outside)

    def attrs(x: Column) -> Column:
        return F.struct(_prefix(x).alias("p"), _etype(x).alias("t"), x.isin(out).alias("o"))

    def with_bounds(a: Column) -> Column:
        at = a["a"]

        def starts(i: Column) -> Column:
            cur, prev = F.get(at, i), F.get(at, i - 1)
            return (~cur["o"]) & (
                (i == 0) | prev["o"] | cur["p"].isin("B", "S") | prev["p"].isin("E", "S")
                | (cur["t"] != prev["t"])
            )

        bounds = F.filter(
            F.transform(at, lambda x, i: F.struct(i.alias("i"), starts(i).alias("s"), x["o"].alias("o"))),
            lambda b: b["s"] | b["o"],
        )
        return let({"a": at, "b": bounds}, emit)

    def emit(v: Column) -> Column:
        at, bounds = v["a"], v["b"]
        n = F.size(at)
        ch = F.filter(
            F.transform(bounds, lambda b, k: F.when(b["s"], F.struct(
                F.get(at, b["i"])["t"].alias("type"), b["i"].alias("start"),
                (F.coalesce(F.get(bounds, k + 1)["i"], n) - 1).alias("end")))),
            lambda c: c.isNotNull(),
        )
        return F.when(n > 0, ch).otherwise(F.array().cast(f"array<{CHUNK_TYPE}>"))

    return _chunks_from_attrs(attrs_col if attrs_col is not None else F.transform(_col(labels), attrs), with_bounds)


def _chunks_from_attrs(attrs_col: Column, with_bounds) -> Column:
    return let({"a": attrs_col}, with_bounds)


def label_attributes(labels: Sequence[str] = LABELS, outside: Sequence[str] = ("O",)) -> Column:
    """Literal per-label (prefix, type, outside) table, indexed by tag id; the
    same rules as ``chunks`` applies to names, folded to a constant."""
    def etype(name: str) -> str:
        rest = name[1:]
        return rest.split("-", 1)[-1] or "_"

    return F.array(*[F.struct(F.lit(n[:1]).alias("p"), F.lit(etype(n)).alias("t"), F.lit(n in outside).alias("o"))
                     for n in labels])


def chunks_from_ids(tags: Column | str, labels: Sequence[str] = LABELS, outside: Sequence[str] = ("O",)) -> Column:
    """``chunks`` for tag-id arrays: label attributes come from a literal table."""
    table = label_attributes(labels, outside)
    return chunks(_col(tags), outside, attrs_col=F.transform(_col(tags), lambda t: F.get(table, t)))


def _chunk_keys(found: Column) -> Column:
    """One string per chunk: sets of atoms are intersected by hashing, sets of structs pair by pair."""
    return F.transform(found, lambda c: F.concat_ws(" ", c["start"].cast("string"), c["end"].cast("string"), c["type"]))


def entity_counts(gold_names: Column | str, pred_names: Column | str,
                  outside: Sequence[str] = ("O",), ids: bool = False) -> Column:
    """Per-row counts as one struct: gold chunks, predicted chunks, matching
    chunks, tokens, equal tokens. With ``ids`` the inputs are tag-id arrays.
    Taking its fields one by one would compute all of it for each."""
    ch = (lambda x: chunks_from_ids(x, LABELS, outside)) if ids else (lambda x: chunks(x, outside))

    def body(v: Column) -> Column:
        g, p = v["g"], v["p"]
        return let({"gc": ch(g), "pc": ch(p), "g": g, "p": p}, lambda c: F.struct(
            F.size(c["gc"]).alias("n_gold"), F.size(c["pc"]).alias("n_pred"),
            F.size(F.array_intersect(_chunk_keys(c["gc"]), _chunk_keys(c["pc"]))).alias("n_tp"), F.size(c["g"]).alias("n_tok"),
            F.size(F.filter(F.arrays_zip(c["g"].alias("a"), c["p"].alias("b")),
                            lambda z: z["a"] == z["b"])).alias("n_eq"),
        ))

    return let({"g": _col(gold_names), "p": _col(pred_names)}, body)


def entity_metrics(df: DataFrame, gold_names: str, pred_names: str,
                   outside: Sequence[str] = ("O",), ids: bool = False) -> DataFrame:
    """Overall entity precision, recall, F1 and token accuracy.
    Inputs are label-name arrays, or tag-id arrays with ``ids=True``."""
    per_row = df.select(F.inline_outer(F.array(entity_counts(gold_names, pred_names, outside, ids))))
    return _scores(per_row.agg(*[F.sum(c).alias(c) for c in ("n_gold", "n_pred", "n_tp", "n_tok", "n_eq")]))


_NOTHING, _OUTSIDE, _UNKNOWN = NUM_LABELS, NUM_LABELS + 1, NUM_LABELS + 2  # codes after the labels': before a corpus, between sentences, other tags


_NULL = -(1 << 62)


def _mark_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """For each code of the label before and of the label at a place: whether a chunk starts, and whether one ends there; the number of
    each code's type, and the types. An unknown tag starts and ends nothing by itself."""
    def etype(name: str) -> str:
        return name[1:].split("-", 1)[-1] or "_"

    known = [(n[:1], etype(n)) for n in LABELS] + [("O", ""), ("O", "_")]
    types = sorted({t for _, t in known})
    start, end = np.zeros((2, _UNKNOWN + 1, _UNKNOWN + 1), bool)
    for a, (pp, pt) in enumerate(known):
        for b, (cp, ct) in enumerate(known):
            end[a, b] = pp in "ES" or (pp in "BI" and cp in "BSO") or (pp not in "O." and pt != ct)
            start[a, b] = cp in "BS" or (pp in "ESO" and cp in "EI") or (cp not in "O." and pt != ct)
    for a, (pp, _) in enumerate(known):
        end[a, _UNKNOWN] = pp in "ES"
    for b, (cp, _) in enumerate(known):
        start[_UNKNOWN, b] = cp in "BS"
    return start, end, np.array([types.index(t) for _, t in known] + [-1]), types


class _Marks(NamedTuple):
    """Chunk ends of a side, end to end: the row, the place in it, the number of the type and the last start before it (-1 where
    the sentence has none); for each row its last start (-1 without)."""

    row: np.ndarray
    at: np.ndarray
    type: np.ndarray
    begin: np.ndarray
    last: np.ndarray


def _marks(tags: np.ndarray, cuts: np.ndarray, first: np.ndarray) -> _Marks:
    """The marks of sentences inside a corpus read as one sequence, each sentence followed by one outside label. ``tags`` are codes;
    ``first`` marks the corpus' first sentence, whose first label follows nothing."""
    start, end, type_of, _ = _mark_tables()
    n = len(cuts) - 1
    base = cuts + np.arange(n + 1)  # a sentence has a place after its last label
    row = np.repeat(np.arange(n), np.diff(base))
    own = np.arange(len(tags)) + np.repeat(np.arange(n), np.diff(cuts))
    cur = np.full(base[-1], _OUTSIDE)
    cur[own] = tags
    prev = np.full(base[-1], _OUTSIDE)
    prev[own + 1] = tags
    prev[base[:-1]] = np.where(first, _NOTHING, _OUTSIDE)
    # A chunk can end without another starting only before an outside label, after which no chunk ends before one
    # starts or an unstarted one ends with a start: of two marks in a row at least one is a start.
    found = np.flatnonzero(start[prev, cur] | end[prev, cur])
    r, at = row[found], found - base[row[found]]
    starts, ends = start[prev, cur][found], end[prev, cur][found]
    begin = np.full(len(found), -1)
    for back in (2, 1):  # the nearer one last
        ok = np.zeros(len(found), bool)
        ok[back:] = (r[back:] == r[:-back]) & starts[:-back]
        begin[ok] = at[np.flatnonzero(ok) - back]
    last = np.full(n, -1)
    last[r[starts]] = at[starts]  # in order: the last one stays
    return _Marks(r[ends], at[ends], type_of[prev[found]][ends], begin[ends], last)


_SIDE = "struct<ends:array<struct<i:int,type:string,begin:int>>,last:int>"
_FLAT = f"struct<n_gold:int,n_pred:int,n_tp:int,n_tok:int,n_eq:int,g:{_SIDE},p:{_SIDE}>"


def _flat_rows(gold: pa.Array, pred: pa.Array, first: pa.Array) -> pa.Array:
    """What one sentence tells of a corpus read as one sequence: its numbers, the chunks whose begin it knows compared, and of each side the
    ends of the others (all ends of the first sentence, whose begin can be that of the corpus) and the last start."""
    is_first = flags(first)
    flat, marks, codes = {}, {}, {}
    for side, rows in (("g", gold), ("p", pred)):
        values, cuts = laid_out(rows)
        tag = pc.fill_null(values.cast(pa.int64()), _NULL).to_numpy(zero_copy_only=False)
        flat[side], codes[side] = tag, cuts
        marks[side] = _marks(np.where((tag >= 0) & (tag < NUM_LABELS), tag, _UNKNOWN), cuts, is_first)
    g, p = marks["g"], marks["p"]
    n = len(is_first)
    sizes = {side: np.diff(cuts) for side, cuts in codes.items()}
    places = np.concatenate([[0], np.cumsum(np.maximum(sizes["g"], sizes["p"]) + 1)])

    def laid(m: _Marks, values: np.ndarray, fill: int) -> np.ndarray:
        out = np.full(places[-1], fill)
        keep = (m.begin >= 0) & ~is_first[m.row]
        out[places[m.row[keep]] + m.at[keep]] = values[keep]
        return out

    same = (laid(g, g.type, -1) == laid(p, p.type, -2)) & (laid(g, g.begin, -1) == laid(p, p.begin, -2))
    row_of = np.repeat(np.arange(n), np.diff(places))
    both = np.minimum(sizes["g"], sizes["p"])
    at = np.arange(both.sum()) - np.repeat(np.cumsum(both) - both, both)
    which = np.repeat(np.arange(n), both)
    left, right = flat["g"][codes["g"][which] + at], flat["p"][codes["p"][which] + at]
    _, _, _, types = _mark_tables()

    def side(m: _Marks, rows: pa.Array) -> pa.Array:
        keep = np.flatnonzero((m.begin < 0) | is_first[m.row])
        ends = records(i=ints(m.at[keep]), type=pa.array(types).take(pa.array(m.type[keep])), begin=ints(m.begin[keep], m.begin[keep] < 0))
        return records(ends=stacked(ends, np.searchsorted(m.row[keep], np.arange(n + 1)), rows), last=ints(m.last, m.last < 0))

    missing = {"g": pc.is_null(gold).to_numpy(zero_copy_only=False), "p": pc.is_null(pred).to_numpy(zero_copy_only=False)}
    return records(n_gold=ints(np.bincount(g.row, minlength=n), missing["g"]), n_pred=ints(np.bincount(p.row, minlength=n), missing["p"]),
                   n_tp=ints(np.bincount(row_of[same], minlength=n)), n_tok=ints(sizes["g"], missing["g"]),
                   n_eq=ints(np.bincount(which[(left == right) & (left != _NULL)], minlength=n), missing["g"] | missing["p"]), g=side(g, gold), p=side(p, pred))


def flat_entity_counts(df: DataFrame, gold: str, pred: str, order: str = "id") -> DataFrame:
    """One row ``n_gold, n_pred, n_tp, n_tok, n_eq`` of a corpus of tag-id arrays read as one sequence in the order of
    ``order`` (unique): a chunk that a sentence's end does not close goes on, and one that nothing starts has the place of the
    last start before it, in whichever sentence.

    All but the open chunk is decided inside the sentence row, for all rows of a batch together. What crosses sentences is one place, the last start so far:
    a running maximum over the sentences' last starts, taken in chunks of the order (see ``positions``). Only sentences
    with a chunk that began earlier are joined with it, with those chunks only; no token array is shuffled."""
    def count(first: pa.Array, pred_rows: pa.Array, gold_rows: pa.Array) -> pa.Array:
        return in_slices(lambda f, p, g: _flat_rows(g, p, f), first, pred_rows, gold_rows)

    lowest = df.agg(F.min(order)).first()[0]
    first = F.coalesce(F.col(order) == F.lit(lowest), F.lit(False))
    # Plain columns go to the worker: what makes them is a projection of its own, which is not merged with this one.
    sides = df.select(F.col(order).alias("_o"), first.alias("_f"), computed_once(F.col(pred)).alias("_p"), computed_once(F.col(gold)).alias("_g"))
    rows = cut_lineage(sides.select("_o", F.arrow_udf(count, _FLAT)("_f", "_p", "_g").alias("m")).select("_o", "m.*"))
    place = lambda side: F.when(F.col(f"{side}.last").isNotNull(), F.struct(F.col("_o").alias("o"), F.col(f"{side}.last").alias("i")))
    narrow = chunked(rows.select("_o", place("g").alias("_gl"), place("p").alias("_pl")), "_o")
    carried = chunk_max(chunk_max(narrow, "_gl", [F.col("_o")], "_gc", inclusive=False), "_pl", [F.col("_o")], "_pc", inclusive=False)
    opened = F.exists("g.ends", lambda x: x["begin"].isNull()) | F.exists("p.ends", lambda x: x["begin"].isNull())
    none = F.lit(None).cast(rows.select(place("g").alias("x")).schema["x"].dataType)
    with_carry = rows.filter(opened).join(carried.select("_o", "_gc", "_pc"), "_o")
    every = rows.filter(~opened).withColumns({"_gc": none, "_pc": none}).unionByName(with_carry)
    begin_of_all = F.struct(F.lit(lowest).cast(rows.schema["_o"].dataType).alias("o"), F.lit(0).alias("i"))

    def keys(side: str) -> Column:
        def key(x: Column) -> Column:
            own = F.when(x["begin"].isNotNull(), F.struct(F.col("_o").alias("o"), x["begin"].alias("i")))
            return F.to_json(F.struct(x["i"].alias("end"), x["type"].alias("type"), F.coalesce(own, F.col(f"_{side}c"), begin_of_all).alias("begin")))
        return F.transform(f"{side}.ends", key)

    counts = every.select("n_gold", "n_pred", (F.col("n_tp") + F.size(F.array_intersect(keys("g"), keys("p")))).alias("n_tp"), "n_tok", "n_eq")
    return counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts.columns])


def _scores(s: DataFrame, *more: str) -> DataFrame:
    p, r = _div(F.col("n_tp"), F.col("n_pred")), _div(F.col("n_tp"), F.col("n_gold"))
    return s.select(F.round(p, ROUND).alias("precision"), F.round(r, ROUND).alias("recall"), F.round(_div(2 * p * r, p + r), ROUND).alias("f1"),
                    F.round(_div(F.col("n_eq"), F.col("n_tok")), ROUND).alias("accuracy"), *more)


def entity_metrics_flat(df: DataFrame, gold: str, pred: str, order: str = "id") -> DataFrame:
    """Entity precision, recall, F1 and token accuracy as over one long sequence (A7), with the three chunk counts."""
    return _scores(flat_entity_counts(df, gold, pred, order), "n_gold", "n_pred", "n_tp")


def evaluation_checks(df: DataFrame, gold: str, pred: str, n_labels: int = len(LABELS)) -> DataFrame:
    """What the token metrics leave out (Q13): rows whose gold and predicted
    lengths differ, positions without a partner, and pairs with a tag outside
    the dictionary, beside the pairs that are counted."""
    def known(x: Column) -> Column:
        return (x >= 0) & (x < n_labels)

    z = F.arrays_zip(F.col(gold).alias("g"), F.col(pred).alias("p"))
    paired = F.filter(z, lambda x: x["g"].isNotNull() & x["p"].isNotNull())
    rows = df.select(
        (F.coalesce(F.size(gold), F.lit(0)) != F.coalesce(F.size(pred), F.lit(0))).cast("long").alias("mismatched_rows"),
        (F.size(z) - F.size(paired)).cast("long").alias("unpaired_tokens"),
        F.size(F.filter(paired, lambda x: ~(known(x["g"]) & known(x["p"])))).cast("long").alias("unknown_tag_pairs"),
        F.size(F.filter(paired, lambda x: known(x["g"]) & known(x["p"]))).cast("long").alias("counted_pairs"))
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in rows.columns])


def evaluate_all(df: DataFrame, gold: str, pred: str) -> dict[str, DataFrame]:
    """All outputs for a scored DataFrame of tag-id arrays (X5): token level,
    entity level (A7) and the checks of what the numbers leave out."""
    conf = confusion(gold_pred_pairs(df, gold, pred))
    return {
        "confusion": conf,
        "confusion_percent": confusion_percent(conf),
        "confusion_totals": confusion_totals(conf),
        "token_metrics": token_metrics(conf),
        "class_report": class_report(conf),
        "entity_metrics": entity_metrics(df, gold, pred, ids=True),
        "checks": evaluation_checks(df, gold, pred),
    }
