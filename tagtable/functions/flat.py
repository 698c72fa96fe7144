"""Array columns a batch at a time (Arrow): the elements of all rows end to end, and where each row's begin.

Operators over pieces and spans do a few steps an element. As nested higher-order functions each step is interpreted and makes
an object; over the flat arrays it is one call for all elements of a batch. They are Columns like the others
(``arrow_udf``); one that takes another's result runs in the same worker, and what lies between them never goes back."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 18


def in_slices(work: Callable[..., pa.Array], *columns: pa.Array, elements: int = SLICE) -> pa.Array:
    """``work`` over runs of rows with about so many elements of the last column, an array: what it holds beside its result
    does not grow with the batch. A row is never cut."""
    sizes = pc.fill_null(pc.list_value_length(columns[-1]), 0).to_numpy(zero_copy_only=False)
    slot = np.cumsum(sizes, dtype=np.int64) // elements
    cuts = [0, *(np.flatnonzero(slot[1:] != slot[:-1]) + 1).tolist(), len(sizes)]
    parts = [work(*[c.slice(lo, hi - lo) for c in columns]) for lo, hi in zip(cuts, cuts[1:])]
    return parts[0] if len(parts) == 1 else pa.concat_arrays(parts)


def laid_out(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The elements of all rows end to end and the places where each row's begin, with the end. A null row has no elements."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return lists.flatten(), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def stacked(values: pa.Array, cuts: np.ndarray, like: pa.Array | None = None) -> pa.Array:
    """Rows of ``values`` between the ``cuts``; null where ``like`` is."""
    mask = pc.is_null(like) if like is not None and like.null_count else None
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values, mask=mask)


def row_starts(cuts: np.ndarray) -> np.ndarray:
    """For each element the place where its row begins."""
    return np.repeat(cuts[:-1], np.diff(cuts))


def fields(structs: pa.Array, *names: str) -> list[pa.Array]:
    """Fields of a flat array of structs; null where the struct is."""
    every = structs.flatten()
    return [every[structs.type.get_field_index(n)] for n in names]


def records(**columns: pa.Array) -> pa.Array:
    return pa.StructArray.from_arrays(list(columns.values()), list(columns))


def ints(values: np.ndarray | pa.Array, null: np.ndarray | None = None) -> pa.Array:
    return values.cast(pa.int32()) if isinstance(values, pa.Array) else pa.array(values.astype(np.int32), mask=null)


def flags(values: pa.Array) -> np.ndarray:
    """Booleans with null as False."""
    return pc.fill_null(values, False).to_numpy(zero_copy_only=False)


def _text(strings: pa.Array) -> tuple[np.ndarray, pa.Buffer]:
    """Byte places of the strings in one buffer, one after the other; null strings are empty."""
    strings = strings.cast(pa.string())
    strings = pc.fill_null(strings, "") if strings.null_count else strings
    _, places, data = strings.buffers()
    if not len(strings):
        return np.zeros(1, np.int32), pa.py_buffer(b"")
    return np.frombuffer(places, np.int32)[strings.offset:strings.offset + len(strings) + 1], data or pa.py_buffer(b"")


def _strings(places: np.ndarray, data: pa.Buffer) -> pa.Array:
    return pa.StringArray.from_buffers(len(places) - 1, pa.py_buffer(np.ascontiguousarray(places, np.int32)), data)


def joined_runs(strings: pa.Array, cuts: np.ndarray) -> pa.Array:
    """Strings joined from each cut to the next; nulls are left out."""
    places, data = _text(strings)
    return _strings(places[cuts], data)


def cut_strings(strings: pa.Array, width: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Strings cut every ``width`` characters, an empty one into one empty cut: the texts end to end, how many of
    them each string has, and the strings' numbers of characters."""
    places, data = _text(strings)
    low, high = int(places[0]), int(places[-1])
    lead = (np.frombuffer(data, np.uint8, high - low, low) & 0xC0) != 0x80 if high > low else np.zeros(0, bool)
    before = np.concatenate([[0], np.cumsum(lead, dtype=np.int64)])[places - low]
    chars = np.diff(before)
    n = np.maximum(-(-chars // width), 1)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    begin = np.append(np.flatnonzero(lead) + low, high)[np.repeat(before[:-1], n) + nth * width]
    return _strings(np.append(begin, high), data), n, chars
