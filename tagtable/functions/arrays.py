"""Helpers for sentence-form array work.

``let`` binds values once per row so lambda bodies can read them by random
access. Catalyst inlines a projected column into its consumer when it is
referenced once, even if that one reference sits inside a lambda that runs
per element; reading a bound lambda variable instead keeps every array
computed exactly once per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(bindings: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """Evaluate ``bindings`` once, then ``body(v)`` where ``v[name]`` reads a binding."""
    packed = F.array(F.struct(*[c.alias(k) for k, c in bindings.items()]))
    return F.get(F.transform(packed, body), 0)


def indices(n: Column) -> Column:
    """0 .. n-1, empty when n <= 0 (``sequence(0, -1)`` would count down)."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def computed_once(c: Column) -> Column:
    """Return ``c`` unchanged, in a projection the optimizer treats as
    non-deterministic, so a later filter on it is not pushed below this point
    with the expensive expression copied into the filter (which would run the
    rule chain twice, and on a scan before any repartition). Partition ids
    are never negative, so the value is the same on every run and retry
    (a ``rand() >= 0`` guard would be folded away by the optimizer)."""
    return F.when(F.spark_partition_id() >= F.lit(0), c)
