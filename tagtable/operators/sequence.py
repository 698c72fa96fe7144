"""A sequence tagger (M1, M2): a hidden Markov model fitted by counting, decoded by Viterbi inside the sentence row.

Words are known by one of ``BUCKETS`` buckets of their md5, so the model has a fixed size whatever the vocabulary: emission scores
of buckets x labels and transition scores of (labels + start) x labels, which is what reaches the driver and is broadcast to the tasks.
Counting is two partial aggregates; a word or label with any share of the rows is merged on the map side. Scores are whole
numbers, 1000 times the natural logarithm of the smoothed relative frequency, so decoding is exact and ties are real: they go to
the lower label. Sentences are decoded where they are: no shuffle."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtable.constants import NUM_LABELS

BUCKETS = 1 << 16
SCALE = 1000
START = -1


class SequenceModel(NamedTuple):
    emission: "np.ndarray"  # buckets x labels
    transition: "np.ndarray"  # labels x labels
    start: "np.ndarray"  # labels


def word_bucket(token: Column) -> Column:
    return F.conv(F.substring(F.md5(token), 1, 4), 16, 10).cast("int")


def fit_sequence(rows: DataFrame, tokens: str = "tokens", tags: str = "ner_tags") -> SequenceModel:
    """From labelled sentences (arrays of the same length; positions without a word or a known label are left out)."""
    import numpy as np

    z = F.arrays_zip(F.col(tokens).alias("w"), F.col(tags).cast("array<int>").alias("t"))
    known = lambda t: t.between(0, NUM_LABELS - 1)
    each = rows.select(F.posexplode_outer(z).alias("i", "z"), F.col(tags).cast("array<int>").alias("all"))
    each = each.select("z.w", "z.t", F.when(F.col("i") == 0, START).otherwise(F.get("all", F.col("i") - 1)).alias("p"))
    each = each.filter(F.col("w").isNotNull() & known(F.col("t")))
    emitted = each.groupBy(word_bucket(F.col("w")).alias("b"), "t").agg(F.count(F.lit(1)).alias("n")).toPandas()  # BUCKETS x labels at most
    passed = each.filter((F.col("p") == START) | known(F.col("p"))).groupBy("p", "t").agg(F.count(F.lit(1)).alias("n")).toPandas()
    e, t = np.zeros((BUCKETS, NUM_LABELS)), np.zeros((NUM_LABELS + 1, NUM_LABELS))
    e[emitted["b"].to_numpy(dtype=int), emitted["t"].to_numpy(dtype=int)] = emitted["n"].to_numpy()
    t[passed["p"].to_numpy(dtype=int), passed["t"].to_numpy(dtype=int)] = passed["n"].to_numpy()  # START counts in the last row
    score = lambda c, total: np.round(SCALE * np.log((c + 1) / total)).astype(np.int64)
    t = score(t, t.sum(1, keepdims=True) + NUM_LABELS)
    return SequenceModel(score(e, e.sum(0, keepdims=True) + BUCKETS), t[:-1], t[-1])


def viterbi(buckets, model: SequenceModel) -> list[int]:
    """The best label sequence of one sentence."""
    import numpy as np

    if not len(buckets):
        return []
    emitted = model.emission[buckets]
    score, back = model.start + emitted[0], []
    for e in emitted[1:]:
        each = score[:, None] + model.transition
        back.append(each.argmax(0))  # the lower label of equals
        score = each.max(0) + e
    path = [int(score.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def predict_sequence(df: DataFrame, model: SequenceModel, tokens: str = "tokens", out: str = "pred") -> DataFrame:
    """Adds the labels of each sentence, an array of ints; null where the tokens are null."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in df.schema.fields if f.name not in (out, "_buckets")]
    hashed = df.select(*[F.col(f"`{f.name}`") for f in kept], F.transform(tokens, lambda w: F.coalesce(word_bucket(w), F.lit(0))).alias("_buckets"))

    def run(batches: Iterator):
        import pyarrow as pa

        m = shared.value
        for batch in batches:
            found = [None if b is None else viterbi(b, m) for b in batch["_buckets"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch[f.name] for f in kept] + [pa.array(found, pa.list_(pa.int32()))], names=[f.name for f in kept] + [out])

    from pyspark.sql import types as T

    return hashed.mapInArrow(run, T.StructType(kept + [T.StructField(out, T.ArrayType(T.IntegerType()))]))
