"""Modelling-corpus assembly: filters, dedup, split, union, distribution
(S6, P2-P4, F1, F2, U1, U2, A1, A2, A8, W6, K5, K6, L2)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtable.constants import LABELS, RUN_DEFAULTS, RUN_PRESETS
from tagtable.functions.arrays import computed_once
from tagtable.session import cut_lineage

ROUND = 6
SUBSETS = ("train", "validation", "test")


def has_digit(tokens: Column | str) -> Column:
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.exists(t, lambda x: x.rlike(r"\p{Nd}"))


def has_apostrophe(tokens: Column | str) -> Column:
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.exists(t, lambda x: x.contains("'"))


def filter_numeric(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Keep rows where no token holds a decimal digit (F1)."""
    return df.filter(~has_digit(tokens))


def filter_apostrophe(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Drop rows where any token holds an apostrophe (F2)."""
    return df.filter(~has_apostrophe(tokens))


def dedup(df: DataFrame, cols: Sequence[str] = ("tokens", "ner_tags"), keep: str | None = None,
          count_col: str | None = None) -> DataFrame:
    """Drop duplicate rows over ``cols`` (A8). With ``keep``, the copy with the
    smallest ``keep`` value survives, so the result does not depend on task
    order. A partial aggregate: copies of one hot text are merged on the map
    side before any row leaves its task."""
    cols = list(cols)
    if keep is None and count_col is None:
        return df.dropDuplicates(cols)
    aggs = []
    if keep is not None:
        aggs.append(F.min(keep).alias(keep))
    if count_col is not None:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    return df.groupBy(*cols).agg(*aggs)


def dedup_by_digest(df: DataFrame, cols: Sequence[str], keep: str, carry: Sequence[str] = ()) -> DataFrame:
    """``dedup`` for callers that need little of a row: copies meet under a
    SHA-256 digest of ``cols`` instead of the whole arrays, the smallest
    ``keep`` survives, and ``carry`` columns (which must follow from ``cols``)
    come along."""
    digest = F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)
    return df.select(digest.alias("_digest"), keep, *carry).groupBy("_digest").agg(
        F.min(keep).alias(keep), *[F.any_value(c).alias(c) for c in carry]).drop("_digest")


def label_counts(tags: Column | str, n: int = len(LABELS)) -> Column:
    """How often each label occurs in a row, in dictionary order."""
    t = F.col(tags) if isinstance(tags, str) else tags
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.size(F.filter(t, lambda x: x == i)).cast("bigint"))


def distribution_of_counts(df: DataFrame, subset: str = "subset", n_tokens: str = "n_tokens", counts: str = "counts",
                           labels: Sequence[str] = LABELS) -> DataFrame:
    """``distribution`` from rows that carry their token and label counts."""
    from pyspark.sql import Window

    g = df.groupBy(subset).agg(F.count(F.lit(1)).alias("Num_of_Rows"), F.sum(n_tokens).cast("bigint").alias("Num_of_Tokens"),
                               *[F.sum(F.get(counts, i)).alias(name) for i, name in enumerate(labels)])
    total = F.sum("Num_of_Rows").over(Window.partitionBy())
    return g.select(F.col(subset).alias("Subset"), "Num_of_Rows", "Num_of_Tokens",
                    F.round(F.col("Num_of_Rows") / total, ROUND).alias("Split"), *[F.col(f"`{n}`") for n in labels])


def hash_bucket(key: Column | str, seed: int = 42, buckets: int = 10000) -> Column:
    """Stable split bucket from the row key: the same row gets the same
    subset however the data is partitioned (unlike ``randomSplit``)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(k, F.lit(seed)), F.lit(buckets))


def assign_subset(df: DataFrame, key: str | Column, train: float = 0.8, validation_of_train: float = 0.2,
                  seed: int = 42, bucket: Column | None = None, buckets: int = 10000,
                  out: str = "subset") -> DataFrame:
    """80/20 split, then 80/20 of the train part: 64/16/20 (W6). ``bucket``
    (an integer Column in [0, buckets)) replaces the hash when given."""
    b = bucket if bucket is not None else hash_bucket(key, seed, buckets)
    t_cut = int(round(buckets * train * (1 - validation_of_train)))
    v_cut = int(round(buckets * train))
    return df.withColumn(out, F.when(b < t_cut, "train").when(b < v_cut, "validation").otherwise("test"))


SPLIT_BITS, ROUND_BITS = 60, 12


def smallest(df: DataFrame, value: str, ks: Sequence[int], bits: int = SPLIT_BITS) -> list[tuple[int, int]]:
    """For each k a cut (t, m): the k rows with the smallest ``value`` (whole, from 0 up to 2 ** bits) are those below t
    and m of those equal to t. A histogram over the leading bits finds the range that a cut lies in, the next one divides that
    range only: at most bits / ROUND_BITS passes over one column, no sort, and only counts of at most 2 ** ROUND_BITS ranges
    a cut come to the driver. A range that a cut ends with needs no further division."""
    done: dict[int, tuple[int, int]] = {k: (0, 0) for k in ks if k <= 0}
    open_at = {k: (0, k) for k in ks if k > 0}  # k -> the range it lies in, how many of that range
    for shift in range(bits - ROUND_BITS, -1, -ROUND_BITS):
        if not open_at:
            break
        ranges = sorted({r for r, _ in open_at.values()})
        rows = df.filter(F.shiftright(value, shift + ROUND_BITS).isin(ranges)).groupBy(F.shiftright(value, shift).alias("r")).count().collect()
        counts = sorted((r["r"], r["count"]) for r in rows)
        for k, (parent, left) in list(open_at.items()):
            for r, n in (x for x in counts if x[0] >> ROUND_BITS == parent):
                if left <= n:
                    open_at[k] = (r, left)
                    if left == n:
                        done[k] = ((r + 1) << shift, 0)
                        del open_at[k]
                    break
                left -= n
            else:  # fewer rows than k
                done[k] = (1 << bits, 0)
                del open_at[k]
    return [done.get(k, open_at.get(k)) for k in ks]


def subset_sizes(n: int, train: float = 0.8, test: float = 0.2) -> tuple[int, int, int]:
    """Rows of train, validation and test (W6): the test part rounded up and the train part down, then the train part
    divided once more in the same way."""
    both = math.floor(train * n)
    return math.floor(train * both), math.ceil(test * both), math.ceil(test * n)


def assign_exact_subset(df: DataFrame, key: str, train: float = 0.8, test: float = 0.2, seed: int = 42,
                        order: Column | None = None, out: str = "subset") -> DataFrame:
    """W6 with exact sizes: rows in the order of a seeded hash of ``key`` (or of ``order``, whole numbers from 0 up to
    2 ** SPLIT_BITS) are cut at ``subset_sizes``. Rows that tie follow a hash of all columns; rows equal in every
    column stay together, so copies go first (``dedup``). The rows themselves are neither sorted nor shuffled."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    top = lambda h: F.shiftrightunsigned(h, 64 - SPLIT_BITS)
    first = order if order is not None else top(F.xxhash64(F.lit(seed), F.col(key)))
    second = top(F.xxhash64(F.lit(seed), *plain))
    places = cut_lineage(df.select(first.cast("long").alias("a"), second.alias("b")))
    sizes = subset_sizes(places.count(), train, test)
    cuts = []
    for t, m in smallest(places, "a", [sum(sizes[: i + 1]) for i in range(3)]):
        tie = smallest(places.filter(F.col("a") == t), "b", [m])[0][0] if m else 0
        cuts.append((F.col("_a") < t) | ((F.col("_a") == t) & (F.col("_b") < tie)))
    subset = F.when(cuts[0], SUBSETS[0]).when(cuts[1], SUBSETS[1]).when(cuts[2], SUBSETS[2])
    return df.withColumns({"_a": first.cast("long"), "_b": second}).withColumn(out, subset).drop("_a", "_b")


def to_modelling(df: DataFrame, tokens: str = "text_tokens", tags: str = "fixed_tags") -> DataFrame:
    """Rename the annotated columns to ``tokens, ner_tags`` and cast the tags
    to ARRAY<BIGINT> (P2, P4)."""
    return df.withColumnsRenamed({tokens: "tokens", tags: "ner_tags"}).withColumn(
        "ner_tags", F.col("ner_tags").cast("array<bigint>"))


def concat_splits(base: DataFrame, external: DataFrame | None, numeric_filter: bool = True,
                  test_apostrophe_filter: bool = True) -> DataFrame:
    """Assemble the three splits (U1, U2): the external corpus is cleaned
    (P3 drop, P4 cast, optional F1), appended to the matching subset keeping
    duplicates, and the test subset loses rows holding an apostrophe (F2)."""
    cols = ["source", "key", "tokens", "ner_tags", "subset"]
    out = base.select(*cols)
    if external is not None:
        ext = external.withColumn("ner_tags", F.col("ner_tags").cast("array<bigint>"))
        if numeric_filter:
            ext = filter_numeric(ext)
        out = out.unionByName(ext.select(*cols))
    if test_apostrophe_filter:
        out = out.filter((F.col("subset") != "test") | ~has_apostrophe("tokens"))
    return out


VERSION_FLAGS = ("concat_external", "filter_numeric_external")


def version_flags(presets=RUN_PRESETS, defaults=RUN_DEFAULTS) -> list[tuple[str, bool, bool]]:
    """Each version's name, whether it takes the external corpus, and whether rows with digits of it go (M4)."""
    base = dict(defaults)
    return [(v, *[bool({**base, **dict(p)}.get(k, 0.0)) for k in VERSION_FLAGS]) for v, p in presets]


def version_corpora(base: DataFrame, external: DataFrame, presets=RUN_PRESETS, defaults=RUN_DEFAULTS) -> DataFrame:
    """The corpora of all versions as one table (M4, U2): each row once, with ``versions``, a bit for every version
    whose corpus holds it. A version that takes the external corpus has it cleaned of rows with digits where its preset says so,
    and loses test rows with an apostrophe, of both sources; another one has the base rows alone. The rows are read and
    tested once, however many versions there are."""
    flags = version_flags(presets, defaults)
    bits = lambda wanted: sum(1 << k for k, f in enumerate(flags) if wanted(*f[1:]))
    mask = lambda n: F.lit(n).cast("long")
    cols = ["source", "key", "tokens", "ner_tags", "subset"]
    dropped = (F.col("subset") == "test") & has_apostrophe("tokens")
    own = base.select(*cols).withColumn("versions", F.when(dropped, mask(bits(lambda c, _: not c))).otherwise(mask(bits(lambda c, n: True))))
    numeric = has_digit("tokens")
    # Computed once, or the filter below would be pushed under it and test every word a second time.
    ext = external.withColumn("ner_tags", F.col("ner_tags").cast("array<bigint>")).select(*cols).withColumn(
        "versions", computed_once(F.when(dropped, mask(0)).when(numeric, mask(bits(lambda c, n: c and not n))).otherwise(mask(bits(lambda c, n: c)))))
    return own.unionByName(ext).filter(F.col("versions") != 0)


def of_version(corpora: DataFrame, version: str, presets=RUN_PRESETS) -> DataFrame:
    """The corpus of one version."""
    k = [v for v, _ in presets].index(version)
    return corpora.filter(F.getbit("versions", F.lit(k)) == 1).drop("versions")


def version_distribution(corpora: DataFrame, presets=RUN_PRESETS) -> DataFrame:
    """Rows and tokens of each version's subsets. Rows are counted once for each set of versions, the few sums are dealt to the versions."""
    sums = corpora.groupBy("subset", "versions").agg(F.count(F.lit(1)).alias("r"), F.sum(F.size("tokens")).alias("t"))
    names = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("version")) for k, (v, _) in enumerate(presets)])
    dealt = sums.select("subset", "r", "t", "versions", F.explode(names).alias("v")).filter(F.getbit("versions", F.col("v.k")) == 1)
    return dealt.groupBy(F.col("v.version").alias("version"), "subset").agg(F.sum("r").alias("n_rows"), F.sum("t").cast("bigint").alias("n_tokens"))


def split_sizes(df: DataFrame, subset: str = "subset", tags: str = "ner_tags") -> DataFrame:
    """Rows, tokens and row share per subset (A2)."""
    from pyspark.sql import Window

    g = df.groupBy(subset).agg(F.count(F.lit(1)).alias("Num_of_Rows"),
                               F.sum(F.size(tags)).cast("bigint").alias("Num_of_Tokens"))
    total = F.sum("Num_of_Rows").over(Window.partitionBy())
    return g.select(F.col(subset).alias("Subset"), "Num_of_Rows", "Num_of_Tokens",
                    F.round(F.col("Num_of_Rows") / total, ROUND).alias("Split"))


def distribution(df: DataFrame, subset: str = "subset", tags: str = "ner_tags",
                 labels: Sequence[str] = LABELS) -> DataFrame:
    """Distribution table (A1 + A2, K6): per subset the row and token counts,
    the row share and one count column per label in dictionary order; a
    label missing from a subset counts 0 (quirk Q15). One pass, row level,
    with partial aggregation; no explode."""
    from pyspark.sql import Window

    rows = df.select(subset, F.posexplode_outer(tags).alias("_pos", "_tag"))
    per_label = [F.count(F.when(F.col("_tag") == i, 1)).alias(name) for i, name in enumerate(labels)]
    g = rows.groupBy(subset).agg(
        F.count(F.when(F.col("_pos").isNull() | (F.col("_pos") == 0), 1)).alias("Num_of_Rows"),
        F.count("_tag").alias("Num_of_Tokens"), *per_label)
    total = F.sum("Num_of_Rows").over(Window.partitionBy())
    return g.select(F.col(subset).alias("Subset"), "Num_of_Rows", "Num_of_Tokens",
                    F.round(F.col("Num_of_Rows") / total, ROUND).alias("Split"),
                    *[F.col(f"`{n}`") for n in labels])
