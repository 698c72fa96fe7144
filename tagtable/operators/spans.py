"""Entity spans from labelled pieces or words.

All operators work inside the sentence's row (sentence form) and in time linear
in its length, so they need no shuffle: runs of equal entity type are found
from their change points, and the overlap rule reads the span just before.
The rows of an Arrow batch are worked on together (``functions/flat``)."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from tagtable.functions.flat import fields, flags, in_slices, ints, laid_out, records, row_starts, stacked
from tagtable.operators.pieces import WORD_MARKER


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


SPAN_TYPE = "struct<type:string,start:int,end:int,first:int,last:int>"


class Spans(NamedTuple):
    """Spans of a batch's rows end to end: each one's type, offsets and first and last item (places among all items),
    and where each row's spans begin."""

    type: pa.Array
    start: pa.Array
    end: pa.Array
    first: np.ndarray
    last: np.ndarray
    cuts: np.ndarray


def find_spans(items: pa.Array, cuts: np.ndarray, outside: str = "0") -> Spans:
    """``entity_spans`` over flat items."""
    entity, start, end = fields(items, "entity", "start", "end")
    coded = entity.dictionary_encode()
    names = coded.dictionary.to_pylist()
    types = list(dict.fromkeys(x.rsplit("-", 1)[-1] for x in names))
    number = {t: k for k, t in enumerate(types)}
    code = pc.fill_null(coded.indices, len(names)).to_numpy(zero_copy_only=False)
    kind = np.array([number[x.rsplit("-", 1)[-1]] for x in names] + [-1])[code]
    opens = np.array([x != outside and x.startswith("B") for x in names] + [False])[code]
    n = len(code)
    change = np.zeros(n + 1, bool)
    change[cuts[:-1]] = True
    change = change[:n]
    change[1:] |= (kind[1:] != kind[:-1]) & (kind[1:] >= 0) & (kind[:-1] >= 0)  # a missing label changes nothing
    runs = np.append(np.flatnonzero(change), n)
    first = np.flatnonzero(opens)
    run = np.cumsum(change)[first] - 1
    last = runs[run + 1] - 1
    of_run = kind[runs[run]]
    return Spans(pa.array(types, pa.string()).take(pa.array(of_run, mask=of_run < 0)), ints(start.take(pa.array(first))), ints(end.take(pa.array(last))),
                 first, last, np.searchsorted(first, cuts))


def entity_spans(items: Column | str, outside: str = "0") -> Column:
    """Merge labelled items into spans.

    Each item whose label starts with 'B' (and is not ``outside``) opens a
    span that runs while the entity type (text after the last '-') stays
    the same; ``B-X B-X`` therefore gives an outer and an inner span (Q17)
    and a bare 'Time' never opens one (Q18). Items are
    ``struct<entity, start, end, ..>``; the result is
    ``array<struct<type, start, end, first, last>>`` with item indices."""
    def merge(rows: pa.Array) -> pa.Array:
        flat, cuts = laid_out(rows)
        s = find_spans(flat, cuts, outside)
        at = row_starts(cuts)[s.first]
        return stacked(records(type=s.type, start=s.start, end=s.end, first=ints(s.first - at), last=ints(s.last - at)), s.cuts)

    def spans(rows: pa.Array) -> pa.Array:
        return in_slices(merge, rows)

    return F.arrow_udf(spans, f"array<{SPAN_TYPE}>")(_col(items))


def piece_boundaries(pieces: pa.Array, cuts: np.ndarray, marker: str = WORD_MARKER) -> tuple[np.ndarray, np.ndarray]:
    """Per flat piece: does a whitespace token start here / end here."""
    marked = flags(pc.starts_with(fields(pieces, "word")[0], marker))
    starts, ends = marked.copy(), np.append(marked[1:], False)
    filled = np.flatnonzero(np.diff(cuts))
    starts[cuts[filled]] = True
    ends[cuts[filled + 1] - 1] = True
    return starts, ends


def accepted_spans(s: Spans, starts_token: np.ndarray, ends_token: np.ndarray) -> Spans:
    """Keep spans that sit on token boundaries and drop a span contained in
    the one just before it (W4).

    ``starts_token`` / ``ends_token`` tell of each item whether a token starts or ends there.
    The containment test looks at the previous span, aligned
    or not, but only once some span has been accepted; before that nothing
    is compared."""
    aligned = starts_token[s.first] & ends_token[s.last]
    row = np.repeat(np.arange(len(s.cuts) - 1), np.diff(s.cuts))
    ok = np.flatnonzero(aligned)
    free = np.zeros(len(row), bool)
    free[ok[np.diff(row[ok], prepend=-1) != 0]] = True  # the row's first aligned span
    before = pa.array(np.arange(len(row)) - 1, mask=np.diff(row, prepend=-1) != 0)
    low, high, end = s.start.take(before), s.end.take(before), pc.subtract(s.end, 1)
    contained = pc.and_kleene(pc.and_kleene(pc.greater_equal(s.start, low), pc.less(s.start, high)),
                              pc.and_kleene(pc.greater_equal(end, low), pc.less(end, high)))
    keep = np.flatnonzero(aligned & (free | flags(pc.invert(contained))))
    some = pa.array(keep)
    return Spans(s.type.take(some), s.start.take(some), s.end.take(some), s.first[keep], s.last[keep], np.searchsorted(keep, s.cuts))


def spans_from_pieces(pieces: Column | str, marker: str = WORD_MARKER) -> Column:
    """Predicted sentence to accepted entity spans (X2 without the model): ``array<struct<type, start, end>>``."""
    def accept(rows: pa.Array) -> pa.Array:
        flat, cuts = laid_out(rows)
        s = accepted_spans(find_spans(flat, cuts), *piece_boundaries(flat, cuts, marker))
        return stacked(records(type=s.type, start=s.start, end=s.end), s.cuts)

    def spans(rows: pa.Array) -> pa.Array:
        return in_slices(accept, rows)

    return F.arrow_udf(spans, "array<struct<type:string,start:int,end:int>>")(_col(pieces))


def joined_offsets(lengths: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Start of each flat token in its row's text, the tokens joined by single spaces (C17)."""
    run = np.concatenate([[0], np.cumsum(lengths + 1, dtype=np.int64)])
    return run[:-1] - run[row_starts(cuts)]


def token_offsets(tokens: Column | str) -> Column:
    """``struct(start, end)`` of each token in the single-space joined
    sentence (C17), by one running sum over the tokens' lengths. What follows a null token has no place."""
    def place(rows: pa.Array) -> pa.Array:
        words, cuts = laid_out(rows)
        lengths = pc.fill_null(pc.utf8_length(words), 0).to_numpy(zero_copy_only=False)
        start = joined_offsets(lengths, cuts)
        missing = np.concatenate([[0], np.cumsum(pc.is_null(words).to_numpy(zero_copy_only=False))])
        at = missing[row_starts(cuts)]
        return stacked(records(start=ints(start, missing[:-1] > at), end=ints(start + lengths, missing[1:] > at)), cuts)

    def offsets(rows: pa.Array) -> pa.Array:
        return in_slices(place, rows)

    return F.arrow_udf(offsets, "array<struct<start:int,end:int>>")(_col(tokens))
