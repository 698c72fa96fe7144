"""Outputs that a retried job may write again (K2, K7): one table, a partition for each run, and a manifest of the runs.

A run's rows replace the rows it wrote before and leave other runs alone (dynamic partition overwrite), then its manifest row
is replaced: number of rows and a sum of row hashes. Readers see the runs that the manifest names with at least one row, so a
job that failed before its manifest row was written adds nothing visible, and running it again gives the table that one
undisturbed run gives. ``incomplete_runs`` names runs whose rows do not agree with their manifest row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtable.session import cut_lineage


def _replace(rows: DataFrame, path: str, run: str) -> None:
    named = rows.withColumns({"run": F.lit(run), "_run": F.lit("run-" + run)})
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_run").parquet(path)


def _manifest_path(path: str) -> str:
    return path.rstrip("/") + "_manifest"


def _content(columns: list[str]) -> list[Column]:
    digest = F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in sorted(columns)]).cast("decimal(38,0)"))
    return [F.count(F.lit(1)).alias("n_rows"), F.coalesce(digest, F.lit(0)).cast("string").alias("digest")]


def write_run(rows: DataFrame, path: str, run: str) -> None:
    """Write (or replace) the rows of ``run``; a column ``run`` is added."""
    rows = cut_lineage(rows)  # data and manifest see the same rows
    if rows.take(1):
        _replace(rows, path, run)
    _replace(rows.agg(*_content(rows.columns)), _manifest_path(path), run)


def run_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``run, n_rows, digest`` of every run written."""
    return spark.read.parquet(_manifest_path(path)).select("run", "n_rows", "digest")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all runs in the manifest, with their ``run``."""
    named = run_manifest(spark, path).filter("n_rows > 0").select("run")
    return spark.read.parquet(path).drop("_run").join(named, "run", "left_semi")


def incomplete_runs(spark: SparkSession, path: str) -> DataFrame:
    """Runs to be written again: in the manifest with other rows than are stored, or stored without a manifest row."""
    data = spark.read.parquet(path).drop("_run")
    stored = data.groupBy("run").agg(*_content([c for c in data.columns if c != "run"]))
    both = run_manifest(spark, path).withColumnsRenamed({"n_rows": "m_rows", "digest": "m_digest"}).join(stored, "run", "full")
    return both.filter(F.coalesce("m_rows", F.lit(-1)) != F.coalesce("n_rows", F.lit(0))).select("run").union(
        both.filter((F.col("m_rows") == F.col("n_rows")) & (F.col("m_digest") != F.col("digest"))).select("run"))


def put_metrics(metrics: DataFrame, path: str, name: str) -> None:
    """Add a named metrics row to a metrics table (K2); written again, it replaces the row of that name."""
    write_run(metrics.select(F.lit(name).alias("Name"), *[F.col(f"`{c}`") for c in metrics.columns if c != "Name"]), path, name)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return read_runs(spark, path).drop("run")
