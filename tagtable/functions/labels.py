"""Label dictionary look-ups and per-position label arithmetic
(J2, C11, C12, C15, C19, W7, F5). All are Column expressions on sentence-form
arrays, so they run inside a projection with no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagtable.constants import LABELS
from tagtable.functions.arrays import let

IGNORE_INDEX = -100
PAD_TOKEN = "<pad>"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _labels_array() -> Column:
    return F.array(*[F.lit(x) for x in LABELS])


def _labels_map() -> Column:
    kv = []
    for i, name in enumerate(LABELS):
        kv += [F.lit(name), F.lit(i)]
    return F.create_map(*kv)


def label_name(tag: Column | str) -> Column:
    """Label id -> name; null for an unknown id (J2). A literal array folds."""
    return F.get(_labels_array(), _col(tag))


def label_id(name: Column | str) -> Column:
    """Label name -> id; null for an unknown name (J2, inverse map)."""
    return F.try_element_at(_labels_map(), _col(name))


def label_names(tags: Column | str) -> Column:
    return F.transform(_col(tags), lambda t: label_name(t))


def label_ids(names: Column | str) -> Column:
    return F.transform(_col(names), lambda n: label_id(n))


def label_type(label: Column | str) -> Column:
    """Entity type = text after the last '-' (C12); 'Time' stays 'Time'."""
    return F.substring_index(_col(label), "-", -1)


def argmax(values: Column | str, width: int | None = None) -> Column:
    """Index (0-based) of the first maximum (C15); optionally over the first
    ``width`` elements only."""
    v = _col(values)
    if width is not None:
        v = F.slice(v, 1, width)
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def pad_truncate(values: Column | str, length: int, pad=IGNORE_INDEX) -> Column:
    """Truncate to ``length`` and right-pad with ``pad``."""
    v = F.slice(_col(values), 1, length)
    missing = F.greatest(F.lit(length) - F.size(v), F.lit(0))
    return F.concat(v, F.array_repeat(F.lit(pad), missing))


def align_labels(word_ids: Column | str, labels: Column | str,
                 label_all_tokens: bool = True) -> Column:
    """Spread word labels over sub-word positions.

    A null word id (special token) gets -100; the first piece of a word gets
    the word's label; later pieces of the same word get it too when
    ``label_all_tokens`` else -100."""
    def body(v: Column) -> Column:
        def one(w: Column, i: Column) -> Column:
            prev = F.get(v["w"], i - 1)
            first_piece = prev.isNull() | (w != prev)
            later = F.get(v["l"], w) if label_all_tokens else F.lit(IGNORE_INDEX)
            return (
                F.when(w.isNull(), F.lit(IGNORE_INDEX))
                .when(first_piece, F.get(v["l"], w))
                .otherwise(later)
            )
        return F.transform(v["w"], one)

    return let({"w": _col(word_ids), "l": _col(labels)}, body)


def drop_masked(pairs: Column | str, label_field: str = "label") -> Column:
    """Remove positions whose label is -100 from an array of structs."""
    return F.filter(_col(pairs), lambda x: x[label_field] != F.lit(IGNORE_INDEX))
