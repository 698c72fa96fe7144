"""Training runs: history records, run-table comparison, name rules and
sweep grids (S4, S5, S8, F4, F7, J3, J4, J6, J8, A9-A11, O2-O5, W5, W8,
C13, C14, C18, M4, L5, L6).

Every group-wise step is either a partial aggregate (map-side combined, so
a run holding a third of all records still ships one row per task) or a
window over chunked positions (see ``positions``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagtable import constants as K
from tagtable.functions.arrays import indices, let
from tagtable.operators.positions import chunk_max, chunk_positions, chunked, positions

ROUND = 6


# -- training history ----------------------------------------------------------
def keep_step_records(records: DataFrame) -> DataFrame:
    """Keep records holding ``loss`` or ``eval_loss`` (F4); end-of-training
    summaries (``train_loss`` only) go."""
    return records.filter(F.col("loss").isNotNull() | F.col("eval_loss").isNotNull())


def history_pairs(records: DataFrame, run: str = "run_id", position: str = "position",
                  value_cols: Sequence[str] = ("loss", "eval_loss", "eval_f1")) -> DataFrame:
    """Merge records pairwise, (1,2), (3,4), ...; keys of the later record win,
    keys only in the earlier one stay; an odd last record is dropped (W5).
    Each group has at most two rows."""
    pair = F.floor((F.col(position) - 1) / 2)
    merged = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(position))).alias(c) for c in value_cols]
    return (
        records.groupBy(run, pair.alias("pair"))
        .agg(F.count(F.lit(1)).alias("_n"), F.max_by("epoch", position).alias("epoch"),
             F.max_by("step", position).alias("step"), *merged)
        .filter(F.col("_n") == 2)
        .drop("_n", "pair")
    )


def merge_records(earlier: Column | str, later: Column | str) -> Column:
    """One map of two: every key of both, the later record's value where both have it (a null of it too)."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (earlier, later))
    return let({"a": a, "b": b}, lambda v: F.map_concat(F.map_filter(v["a"], lambda k, _: ~F.map_contains_key(v["b"], k)), v["b"]))


def is_step_record(record: Column | str) -> Column:
    """Does a record (a map) hold a ``loss`` or ``eval_loss`` key."""
    r = F.col(record) if isinstance(record, str) else record
    return F.map_contains_key(r, F.lit("loss")) | F.map_contains_key(r, F.lit("eval_loss"))


def merge_history(records: DataFrame, run: str = "run_id", position: str = "position", record: str = "record") -> DataFrame:
    """W5 for records with any keys, one map a row: (1,2), (3,4), ... merged, an odd last record dropped. Output
    ``run, pair, record``. At most two rows meet, whatever a run's length."""
    pair = F.floor((F.col(position) - 1) / 2).cast("long")
    both = records.groupBy(run, pair.alias("pair")).agg(
        F.count(F.lit(1)).alias("_n"), F.min_by(record, position).alias("_a"), F.max_by(record, position).alias("_b"))
    return both.filter(F.col("_n") == 2).select(run, "pair", merge_records("_a", "_b").alias(record))


def merge_log(log: Column | str) -> Column:
    """W5 on a whole history in one row: an array of maps, step records only (F4), merged pairwise."""
    kept = F.filter(F.col(log) if isinstance(log, str) else log, is_step_record)
    return let({"r": kept}, lambda v: F.transform(
        indices(F.floor(F.size(v["r"]) / 2).cast("int")), lambda i: merge_records(F.get(v["r"], 2 * i), F.get(v["r"], 2 * i + 1))))


def best_epoch(pairs: DataFrame, run: str = "run_id", metric: str = "eval_f1") -> DataFrame:
    """Best evaluation per run by ``metric``; ties go to the earliest epoch."""
    key = F.struct(F.col(metric), (-F.col("epoch")).alias("neg_epoch"))
    return pairs.filter(F.col(metric).isNotNull()).groupBy(run).agg(
        F.max_by("epoch", key).alias("best_epoch"), F.max(metric).alias(f"best_{metric}"))


def early_stop(pairs: DataFrame, patience: int, run: str = "run_id", metric: str = "eval_f1",
               order: str = "step") -> DataFrame:
    """Epoch at which early stopping fires: the first evaluation where
    ``patience`` evaluations in a row have not beaten the best so far (W8).
    Null when it never fires. One probe cuts the order column into chunks;
    the index, the best so far and the last improvement are carried over
    those same chunks (see ``positions``)."""
    ev = pairs.filter(F.col(metric).isNotNull()).select(run, order, "epoch", metric)
    by_order = [F.col(order).asc_nulls_last(), F.col("epoch"), F.col(metric)]
    ev = chunk_positions(chunked(ev, order, by=[run]), by_order, "eval_idx")
    ev = chunk_max(ev, metric, by_order, "prev_best", inclusive=False)
    ev = ev.withColumn("_imp_idx", F.when(F.col("prev_best").isNull() | (F.col(metric) > F.col("prev_best")), F.col("eval_idx")))
    ev = chunk_max(ev, "_imp_idx", by_order, "last_improved")
    ev = ev.withColumn("streak", F.col("eval_idx") - F.col("last_improved"))
    return ev.groupBy(run).agg(
        F.min(F.when(F.col("streak") >= patience, F.col("epoch"))).alias("stop_epoch"),
        F.count(F.lit(1)).alias("n_evals"))


# -- run names -----------------------------------------------------------------
def parent_version(name: Column | str, pattern: str = K.PARENT_VERSION_PATTERN,
                   default: str = K.DEFAULT_PARENT_VERSION) -> Column:
    """Generation of a run from its name (C13); no match gives ``default``.
    ``regexp_extract`` yields '' rather than null on no match."""
    n = F.col(name) if isinstance(name, str) else name
    return F.coalesce(F.nullif(F.regexp_extract(n, pattern, 1), F.lit("")), F.lit(default))


def family(name: Column | str) -> Column:
    """Name without its last dotted part (C14)."""
    n = F.col(name) if isinstance(name, str) else name
    parts = F.split(n, r"\.")
    return F.array_join(F.slice(parts, 1, F.size(parts) - 1), ".")


def version_suffix(name: Column | str) -> Column:
    n = F.col(name) if isinstance(name, str) else name
    return F.substring_index(n, ".", -1).try_cast("bigint")


def has_version(name: Column | str) -> Column:
    """Does the name end in a digit (C14)."""
    n = F.col(name) if isinstance(name, str) else name
    return n.rlike("[0-9]$")


def next_version(names: DataFrame, name: str = "Name") -> DataFrame:
    """Next free version number per family: max numeric suffix + 1, or 1 (A10)."""
    return names.groupBy(family(name).alias("family")).agg(
        (F.coalesce(F.max(version_suffix(name)), F.lit(0)) + 1).alias("next_version"))


def natural_key(name: Column | str) -> Column:
    """Sort key for natural order (O4): each run of digits loses its leading
    zeros and gets its length in front (ten digits), so ``V0.0.10`` sorts
    after ``V0.0.9`` whatever the length of the runs."""
    n = F.col(name) if isinstance(name, str) else name
    parts = F.regexp_extract_all(n, F.lit("([0-9]+|[^0-9]+)"), 1)

    def one(x: Column) -> Column:
        digits = F.regexp_replace(x, "^0+", "")
        return F.when(x.rlike("^[0-9]"), F.concat(F.lpad(F.length(digits).cast("string"), 10, "0"), digits)).otherwise(x)

    return F.array_join(F.transform(parts, one), "")


def top_k_per_group(df: DataFrame, group: str, order: Sequence[Column], k: int,
                    salt_buckets: int = 64, salt_key: str | None = None, out: str = "rank") -> DataFrame:
    """Top ``k`` rows per group by ``order`` in two rounds: first per
    (group, salt) bucket, so a hot group is ranked by many tasks, then over
    the at most ``k * salt_buckets`` survivors per group (O3)."""
    salt = F.pmod(F.xxhash64(F.col(salt_key or group), *[F.col(c) for c in df.columns]), F.lit(salt_buckets))
    first = df.withColumn("_salt", salt).withColumn(
        "_r", F.row_number().over(Window.partitionBy(group, "_salt").orderBy(*order)))
    survivors = first.filter(F.col("_r") <= k).drop("_r", "_salt")
    ranked = survivors.withColumn(out, F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.filter(F.col(out) <= k)


# -- model to test-file matching -----------------------------------------------
GRAM = 4


def _grams(c: Column, least: Column | int, most: Column | int) -> Column:
    """Distinct substrings of ``least`` to ``most`` characters."""
    sizes = F.filter(F.sequence(F.lit(1), F.lit(GRAM)), lambda n: (n >= least) & (n <= most) & (n <= F.length(c)))
    return F.array_distinct(F.flatten(F.transform(sizes, lambda n: F.transform(
        F.sequence(F.lit(1), F.length(c) - n + 1), lambda p: F.substring(c, p, n)))))


def containing_files(names: DataFrame, files: DataFrame, name: str, file: str) -> DataFrame:
    """Pairs of a name and a file that contains it (not empty ones). An inverted index from the files' substrings of up to
    ``GRAM`` characters gives each name its rarest one (of ``GRAM`` characters, or the name itself if shorter); only the files
    with that one are compared. A name with a substring that no file has meets none. Every side grows with the names or
    files, and these compress well: no side is broadcast, or the driver would hold many times what Spark measures."""
    cores = files.sparkSession.sparkContext.defaultParallelism  # names are few bytes but many substrings: a task for each core
    postings = files.select(F.col(file).alias("_file")).distinct().repartition(cores, "_file").select("_file", F.explode(_grams(F.col("_file"), 1, GRAM)).alias("_gram"))
    frequency = postings.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    own = names.select(F.col(name).alias("_name")).distinct().repartition(cores, "_name").select(
        "_name", F.explode(_grams(F.col("_name"), F.least(F.length("_name"), F.lit(GRAM)), GRAM)).alias("_gram"))
    rated = own.join(frequency.hint("merge"), "_gram", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    rarest = rated.groupBy("_name").agg(F.min(F.struct("_n", "_gram")).alias("_r")).filter(F.col("_r._n") > 0)
    pairs = rarest.select("_name", F.col("_r._gram").alias("_gram")).join(postings.hint("merge"), "_gram")
    return pairs.filter(F.contains("_file", "_name")).select(F.col("_name").alias(name), F.col("_file").alias(file))


def match_models_to_files(models: DataFrame, files: DataFrame, name: str = "Name", file_col: str = "file") -> DataFrame:
    """Test file per model (J3): files containing the model name, else files
    containing the name minus its last two characters; the greatest file
    name is taken so the choice is deterministic. Names need no common
    prefix and may stand anywhere in the file name."""
    names = models.select(name, F.expr(f"substring({name}, 1, length({name}) - 2)").alias("_t"))
    asked = names.select(F.explode(F.array(name, "_t")).alias("_asked"))
    found = containing_files(asked, files.select(file_col), "_asked", file_col).groupBy("_asked").agg(F.max(file_col).alias("_found"))
    as_is = lambda c, out: found.select(F.col("_asked").alias(c), F.col("_found").alias(out))
    out = names.join(as_is(name, "exact_file").hint("merge"), name, "left").join(as_is("_t", "trimmed_file").hint("merge"), "_t", "left")
    return out.select(
        name,
        F.coalesce("exact_file", "trimmed_file").alias(file_col),
        F.when(F.col("exact_file").isNotNull(), "exact").when(F.col("trimmed_file").isNotNull(), "trimmed")
        .alias("matched_by"),
    )


def pick_version_folder(versions: DataFrame, folders: DataFrame, version: str = "version", folder: str = "folder",
                        at_start: bool = False) -> DataFrame:
    """Model folder of each version (J4): the least folder name that contains
    the version, or starts with it; null where there is none. The least is
    taken because the order of a directory listing is arbitrary."""
    wanted = versions.select(version).distinct()
    pairs = containing_files(wanted, folders.select(folder), version, folder)
    if at_start:
        pairs = pairs.filter(F.startswith(folder, version))
    found = pairs.groupBy(version).agg(F.min(folder).alias(folder))
    return wanted.join(found, version, "left")


def version_test_rows(version: Column, table: Sequence[tuple[str, int]] = K.VERSION_TEST_ROWS,
                      default: int = K.VERSION_TEST_ROWS_DEFAULT) -> Column:
    """Version-specific default test size, else the fallback."""
    kv = []
    for k, v in table:
        kv += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*kv), version), F.lit(default))


# -- sweeps and configurations ---------------------------------------------------
def param_grid_from_values(values: DataFrame, value_col: str, names: Sequence[str]) -> DataFrame:
    """Product of one value list with itself, once per name (J6, ``repeat``).
    Values are numbered; the grid is a range of n^k numbers, spread over
    partitions, whose digits in base n are joined to the values."""
    digits = positions(values.select(value_col).distinct(), value_col, out="_nth").select(
        (F.col("_nth") - 1).alias("_digit"), F.col(value_col).alias("_v"))
    n = digits.count()
    out = values.sparkSession.range(n ** len(names))
    for k, name in enumerate(names):
        own = digits.select(F.col("_digit").alias("_d"), F.col("_v").alias(name))
        digit = F.floor(F.col("id") / F.lit(n**k)) % F.lit(max(n, 1))
        out = out.withColumn("_d", digit).join(own, "_d").drop("_d")
    return out.select(*names)


def param_grid(spark: SparkSession, params: Mapping[str, Sequence]) -> DataFrame:
    """Grid over literal parameter lists (J6); each list is a literal array."""
    out = spark.range(1).select()
    for n, vals in params.items():
        out = out.select("*", F.explode(F.array(*[F.lit(v) for v in vals])).alias(n))
    return out


def config_overlay(overrides: DataFrame, defaults: Mapping[str, object], run: str = "run_id") -> DataFrame:
    """Long-form configuration per run: an override when the run sets one,
    else the default (M4). ``overrides`` has one nullable column per key."""
    entries = F.array(*[
        F.struct(F.lit(k).alias("param"),
                 F.coalesce(F.col(k).cast("string"), F.lit(str(v))).alias("value"),
                 F.col(k).isNotNull().alias("overridden"))
        for k, v in defaults.items()
    ])
    return overrides.select(run, F.inline(entries))


def preset_overlay(runs: DataFrame, version: Column, run: str = "run_id",
                   presets: Sequence[tuple[str, Sequence[tuple[str, float]]]] = K.RUN_PRESETS,
                   defaults: Sequence[tuple[str, float]] = K.RUN_DEFAULTS) -> DataFrame:
    """Configuration rows of each run from the preset of its version (M4): a
    value of the preset, else the default, else null. A version without a
    preset takes the defaults. Output ``run, param, value, overridden``."""
    keys = list(dict.fromkeys([k for k, _ in defaults] + [k for _, p in presets for k, _ in p]))
    table = F.create_map(*[x for v, p in presets for x in (
        F.lit(v), F.struct(*[F.lit(dict(p).get(k)).cast("double").alias(k) for k in keys]))])
    own = F.try_element_at(table, version)
    entries = F.array(*[F.struct(F.lit(k).alias("param"), F.coalesce(own[k], F.lit(dict(defaults).get(k)).cast("double")).alias("value"),
                                 own[k].isNotNull().alias("overridden")) for k in keys])
    return runs.select(run, F.inline(entries))


def sort_runs(runs: DataFrame, metrics: Sequence[str], name: str = "Name") -> DataFrame:
    """Runs by several metrics, all descending (O2); ties by natural name order."""
    return runs.orderBy(*[F.col(f"`{m}`").desc() for m in metrics], natural_key(name), name)


def generations(runs: DataFrame, group: str = "parent_version") -> DataFrame:
    """Distinct groups in order."""
    return runs.select(group).distinct().orderBy(group)


def metrics_long(runs: DataFrame, name: str = "Name",
                 groups: Sequence[tuple[str, Sequence[str]]] = K.EVALUATION_COLUMNS, keep: Sequence[str] = ()) -> DataFrame:
    """Wide metric columns to ``(Name, category, metric, value)`` rows (C18), with the ``keep`` columns."""
    entries = F.array(*[
        F.struct(F.lit(cat).alias("category"), F.lit(m).alias("metric"), F.col(f"`{m}`").cast("double").alias("value"))
        for cat, cols in groups for m in cols
    ])
    return runs.select(name, *keep, F.inline(entries))
