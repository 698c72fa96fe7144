"""Readers for the driver's Parquet tables and the library's own I/O
(S1-S5, K1, K7, O1, C20)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan one Parquet table; selecting columns here lets the scan prune."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*columns) if columns else df


def spread(df: DataFrame, key: str | None = None, min_partitions: int | None = None, rows_per_task: int | None = None) -> DataFrame:
    """Give CPU-heavy per-row work (regex chains over text) at least one
    task per core. A scan of a large table already has thousands of splits
    and passes through untouched; only an input with fewer splits than the
    cluster's parallelism (one small file, one row group) is hash-spread by
    its key, which is deterministic under task retries. With ``rows_per_task``
    (narrow rows with much work each) tasks grow in number with the rows, not in
    length; the rows of a Parquet scan are counted from its footers."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if rows_per_task:
        target = max(target, -(-df.count() // rows_per_task))
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, key) if key else df.repartition(target)


SENTENCE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lemma_text", T.StringType()),
])


def read_sentences_csv(spark: SparkSession, path: str, schema: T.StructType = SENTENCE_SCHEMA,
                       multi_line: bool = True) -> DataFrame:
    """Raw sentence CSV (S1): comma, UTF-8, header, quoted multi-line cells.
    An explicit schema avoids an inference pass over the whole input. Each file
    with multi-line cells is one task; ``lines.csv_records`` reads such files by
    many tasks and keeps the rejects, and ``multi_line=False`` does where no cell holds a line end."""
    return (
        spark.read.schema(schema)
        .option("header", "true").option("multiLine", str(multi_line).lower())
        .option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
        .csv(path)
    )


def first_rows(df: DataFrame, n: int | None, order_col: str = "id") -> DataFrame:
    """First ``n`` rows in key order, or all rows when ``n`` is None (O1). For a key of whole numbers the n-th smallest
    is found by counting (``smallest``) and the rows are filtered: no sort, and no task that takes all n. Rows without a key come last."""
    if n is None:
        return df
    if df.schema[order_col].dataType.typeName() not in ("integer", "long", "short", "byte"):
        return df.orderBy(F.col(order_col).asc_nulls_last()).limit(n)
    from tagtable.operators.datasets import SPLIT_BITS, smallest

    low = df.agg(F.min(order_col)).first()[0] or 0
    place = F.coalesce(F.col(order_col).cast("long") - F.lit(low), F.lit((1 << SPLIT_BITS) - 1))
    t, m = smallest(df.select(place.alias("v")), "v", [n])[0]
    below = df.filter(place < t)
    return below.unionByName(df.filter(place == t).limit(m)) if m else below


def run_stamp(ts_col) -> "F.Column":
    """Run timestamp text ``dd_MM_yyyy__HH_mm_ss`` (C20); the caller passes the time."""
    return F.date_format(ts_col, "dd_MM_yyyy__HH_mm_ss")


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a result table (K1, K2, K5-K7). Arrays stay arrays in Parquet;
    for CSV they are written as JSON text with every field quoted."""
    if fmt == "csv":
        conv = {f.name: F.to_json(F.col(f.name)) for f in df.schema.fields
                if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))}
        df = df.withColumns(conv) if conv else df
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", "true").option("quoteAll", "true").option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)


def read_run_table(spark: SparkSession, path: str, name: str = "Name") -> DataFrame:
    """Run-table CSV of a sweep or of several trainings (S4): one row per run,
    the run's name and metric columns such as ``test/f1``. Columns are named by
    the header; all but the name that hold numbers only become doubles."""
    raw = spark.read.option("header", "true").option("quote", '"').option("escape", '"').csv(path)
    others = [c for c in raw.columns if c != name]
    if not others:
        return raw
    numeric = raw.agg(*[F.coalesce(F.bool_and(F.col(f"`{c}`").isNull() | F.col(f"`{c}`").try_cast("double").isNotNull()), F.lit(True))
                        .alias(f"c{i}") for i, c in enumerate(others)]).first()
    return raw.withColumns({c: F.col(f"`{c}`").cast("double") for i, c in enumerate(others) if numeric[i]})


def read_splits(spark: SparkSession, paths: dict[str, str], label_map: dict[int, int] | None = None,
                tags: str = "ner_tags", fmt: str = "parquet") -> DataFrame:
    """External corpus kept as one file per split (S6): rows of all paths with
    their ``subset``. ``label_map`` renames label ids that do not follow this
    library's order (Q24); an id it does not name stays."""
    parts = [spark.read.format(fmt).load(path).withColumn("subset", F.lit(subset)) for subset, path in paths.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    if label_map:
        mapping = F.create_map(*[F.lit(x) for kv in label_map.items() for x in kv])
        out = out.withColumn(tags, F.transform(tags, lambda t: F.coalesce(F.try_element_at(mapping, t.cast("int")).cast("bigint"), t.cast("bigint"))))
    return out


def read_history_json(spark: SparkSession, path: str) -> DataFrame:
    """Training-history files (S5): one JSON object per file with a
    ``log_history`` array. Many runs are read in one scan; the file path is
    the run key and the array position the record order."""
    raw = spark.read.option("multiLine", "true").json(path)
    return raw.select(
        F.col("_metadata.file_path").alias("run_id"),
        F.posexplode("log_history").alias("position", "rec"),
    ).select("run_id", (F.col("position") + 1).alias("position"), "rec.*")


def read_history_logs(spark: SparkSession, path: str) -> DataFrame:
    """Training-history files (S5) with whatever keys their records have: ``run_id`` (the file's path) and ``log``,
    an array of maps from key to the value's JSON text. No pass over the files to infer a schema."""
    raw = spark.read.schema("log_history array<map<string,string>>").option("multiLine", "true").json(path)
    return raw.select(F.col("_metadata.file_path").alias("run_id"), F.col("log_history").alias("log"))


def write_history_lines(records: DataFrame, path: str) -> None:
    """History records ``run_id, position, record`` (a map) as JSON lines: one file holds the records of many runs."""
    records.select("run_id", "position", "record").write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_history_lines(spark: SparkSession, path: str, run_type: str = "string") -> DataFrame:
    """``run_id, position, record`` of JSON lines; a record keeps all its keys, values as JSON text. Files are splittable."""
    return spark.read.schema(f"run_id {run_type}, position bigint, record map<string,string>").json(path)
