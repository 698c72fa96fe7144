"""Row positions and running maxima within a key without one task per key.

``row_number() over (partition by key order by o)`` sends every row of a key
to one task; one key may hold a third of all rows. Here the order values are
cut into chunks at (approximate) quantiles, so a (key, chunk) group holds
about one ``CHUNKS``-th of the rows at most, however sparse or clustered the
values are. Rows are numbered inside their chunk, and each chunk is offset by
the counts of the earlier chunks of its key. That table has at most one row
per (key, chunk): a bounded number per key, joined on both columns.

Nulls: a null key is a key of its own (keys are compared as structs, which
are null-safe); a null order value comes last. Ties in the order column get
consecutive positions in the order of ``ties`` (by default a hash of the
row), so each row has its own position and reruns agree; only rows equal in
every column may trade places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNKS = 1024
INF = float("inf")


def chunked(df: DataFrame, order_col: str, by: Sequence[str] = (), chunk_width: int | None = None,
            chunks: int = CHUNKS) -> DataFrame:
    """Add ``_key`` (the ``by`` columns) and ``_chunk``, monotone in the order
    column. The cut points come from one probe over that column alone;
    ``chunk_width`` replaces them by steps of a fixed width."""
    value = F.coalesce(F.col(order_col).cast("double"), F.lit(INF))
    keyed = df.withColumn("_key", F.struct(*[F.col(c) for c in by]) if by else F.lit(0))
    if chunk_width is not None:
        return keyed.withColumn("_chunk", F.when(value < INF, F.floor(value / F.lit(chunk_width))).otherwise(F.lit(2**62)))
    probs = [i / chunks for i in range(1, chunks)]
    cuts = df.agg(F.percentile_approx(F.col(order_col).cast("double"), probs, 100 * chunks)).first()[0] or [0.0]
    splits = [-INF, *sorted(set(cuts)), INF]
    cut = Bucketizer(splits=splits, inputCol="_value", outputCol="_chunk", handleInvalid="keep")
    return cut.transform(keyed.withColumn("_value", value)).drop("_value")


def _row_order(df: DataFrame, order_col: str, ties: Sequence[Column] | None) -> list[Column]:
    if ties is None:
        plain = [f.name for f in df.schema.fields if not f.dataType.typeName() in ("map", "variant")]
        ties = [F.xxhash64(*[F.col(f"`{c}`") for c in plain])]
    return [F.col(order_col).asc_nulls_last(), *ties]


def _earlier(d: DataFrame, agg: Column, over: Column, out: str) -> DataFrame:
    """Per (key, chunk): ``over`` of ``agg`` over the earlier chunks of the key."""
    before = Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return d.groupBy("_key", "_chunk").agg(agg.alias("_a")).select("_key", "_chunk", over.over(before).alias(out))


def chunk_positions(d: DataFrame, order: list[Column], out: str) -> DataFrame:
    """1-based positions of rows that ``chunked`` has prepared."""
    offsets = _earlier(d, F.count(F.lit(1)), F.sum("_a"), "_off")
    local = Window.partitionBy("_key", "_chunk").orderBy(*order)
    ranked = d.withColumn(out, F.row_number().over(local)).join(offsets, ["_key", "_chunk"])
    return ranked.withColumn(out, F.coalesce(F.col("_off"), F.lit(0)) + F.col(out)).drop("_off")


def chunk_max(d: DataFrame, value_col: str, order: list[Column], out: str, inclusive: bool = True) -> DataFrame:
    """Running maximum of rows that ``chunked`` has prepared."""
    earlier = _earlier(d, F.max(value_col), F.max("_a"), "_prev")
    local = Window.partitionBy("_key", "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    local_max = d.withColumn(out, F.max(value_col).over(local)).join(earlier, ["_key", "_chunk"])
    return local_max.withColumn(out, F.greatest("_prev", out)).drop("_prev")


def positions(df: DataFrame, order_col: str, by: Sequence[str] = (), out: str = "position",
              chunk_width: int | None = None, ties: Sequence[Column] | None = None) -> DataFrame:
    """Add a 1-based ``out`` column: the row's rank by ``order_col`` inside
    its ``by`` group. Every row is kept; see the module text for nulls and
    ties."""
    d = chunked(df, order_col, by, chunk_width)
    return chunk_positions(d, _row_order(df, order_col, ties), out).drop("_key", "_chunk")


def prefix_max(df: DataFrame, value_col: str, order_col: str, by: Sequence[str] = (),
               out: str = "running_max", inclusive: bool = True,
               chunk_width: int | None = None, ties: Sequence[Column] | None = None) -> DataFrame:
    """Running maximum of ``value_col`` in ``order_col`` order within ``by``."""
    d = chunked(df, order_col, by, chunk_width)
    return chunk_max(d, value_col, _row_order(df, order_col, ties), out, inclusive).drop("_key", "_chunk")
