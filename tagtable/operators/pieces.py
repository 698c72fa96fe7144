"""Sub-word pieces to words (W2) and word ids per piece (input of W7).

Sentence form works on ``array<struct<entity, word, start, end>>`` inside
one row: linear in the sentence length and free of shuffles. The token-form
variant (one row per piece) uses a window per sentence instead."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagtable.functions.arrays import let
from tagtable.functions.flat import fields, in_slices, ints, joined_runs, laid_out, records, row_starts, stacked

WORD_MARKER = "Ġ"
PIECES_TYPE = "array<struct<entity:string,word:string,start:int,end:int>>"
WORDS_TYPE = "array<struct<entity:string,word:string,start:int,end:int,first_piece:int,n_pieces:int>>"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _firsts(p: Column, marker: str) -> Column:
    """Indexed first pieces of every word: piece 0, and each piece whose text
    starts with the marker."""
    indexed = F.transform(p, lambda x, i: F.struct(i.alias("i"), x.alias("p")))
    return F.filter(indexed, lambda x: (x["i"] == 0) | x["p"]["word"].startswith(marker))


def words_from_pieces(pieces: Column | str, marker: str = WORD_MARKER) -> Column:
    """Roll pieces up to words: ``array<struct<entity, word, start, end,
    first_piece, n_pieces>>``. The first piece's entity wins."""
    def roll_up(rows: pa.Array) -> pa.Array:
        items, cuts = laid_out(rows)
        entity, text, start, end = fields(items, "entity", "word", "start", "end")
        marked = pc.fill_null(pc.starts_with(text, marker), False)
        begins = np.append(marked.to_numpy(zero_copy_only=False), False)
        begins[cuts[:-1]] = True
        first = np.flatnonzero(begins[:-1])
        bounds = np.append(first, len(items))
        head, tail = pa.array(first), pa.array(bounds[1:] - 1)
        word = joined_runs(pc.if_else(marked, pc.utf8_slice_codeunits(text, len(marker)), text), bounds)
        return stacked(records(entity=entity.take(head), word=word, start=ints(start.take(head)), end=ints(end.take(tail)),
                               first_piece=ints(first - row_starts(cuts)[first]), n_pieces=ints(np.diff(bounds))), np.searchsorted(first, cuts), rows)

    def words(rows: pa.Array) -> pa.Array:
        return in_slices(roll_up, rows)

    return F.arrow_udf(words, WORDS_TYPE)(_col(pieces))


def piece_word_ids(pieces: Column | str, marker: str = WORD_MARKER,
                   special_tokens: bool = True) -> Column:
    """Word index of every piece (``word_ids``); with ``special_tokens`` a
    null is added at both ends, as a tokenizer's start/end tokens."""
    def body(v: Column) -> Column:
        p, firsts = v["p"], v["f"]
        return F.flatten(F.transform(
            firsts,
            lambda f, k: F.array_repeat(k, F.coalesce(F.get(firsts, k + 1)["i"], F.size(p)) - f["i"]),
        ))

    ids = let({"p": _col(pieces)}, lambda a: let({"p": a["p"], "f": _firsts(a["p"], marker)}, body))
    if special_tokens:
        null = F.array(F.lit(None).cast("int"))
        ids = F.concat(null, ids, null)
    return ids


def words_from_piece_rows(df: DataFrame, key: str = "id", idx: str = "idx",
                          word: str = "word", entity: str = "entity",
                          marker: str = WORD_MARKER) -> DataFrame:
    """Token-form W2 for pieces already exploded to rows: a running count of
    word starts numbers the words, and ``min_by`` keeps the first entity."""
    w = Window.partitionBy(key).orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)
    starts = F.when((F.col(idx) > 0) & F.col(word).startswith(marker), 1).otherwise(0)
    numbered = df.withColumn("word_idx", F.sum(starts).over(w))
    return numbered.groupBy(key, "word_idx").agg(
        F.min_by(entity, idx).alias(entity),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
    )
