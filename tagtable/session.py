"""Session helpers: a local session for tests and the bench, and the shared
checkpoint folder taken from the cluster's own setting."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library expects. Shuffle partitions are a
# local default; on a cluster AQE coalesces from whatever the job sets.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Text stages are CPU-bound: do not merge post-shuffle partitions down to
    # a few tasks just because the shuffled bytes are small.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tagtable", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared, fault-tolerant folder and is
    used as is. Only when it is unset (local tests) is a scratch folder made.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if conf_dir:
        if not current:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    if current:
        return current
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local_dir = tempfile.mkdtemp(prefix="tagtable-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local_dir)
    spark.sparkContext.setCheckpointDir(local_dir)
    return local_dir


ARROW_BATCH_BYTES = 4 << 20


def small_arrow_batches(spark: SparkSession, limit: int = ARROW_BATCH_BYTES) -> None:
    """Lets no batch to a Python worker be larger than ``limit``, where the session does not already. For whole documents: as pieces and
    words a text takes up several times its bytes, in the worker and where its results arrive."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if not 0 < now <= limit:
        spark.conf.set(key, str(limit))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never a
    local checkpoint: executors may be lost)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder, for tables that a job writes and reads again."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` written below the shared checkpoint folder as Parquet and read from there: compressed, and a later job reads
    the columns it needs, and with ``partition_by`` the folders it needs. For tables whose rows are wide."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
