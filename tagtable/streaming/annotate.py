"""Structured Streaming entry points.

The reference has no streaming operator; the normalisation, tokenising and
tag-rule functions are pure Column expressions, so the same annotation runs
unchanged on a streaming DataFrame (new sentence files arriving in a
folder). State-free: no watermark is needed."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtable.functions.normalize import normalize
from tagtable.functions.rules import fix_tags
from tagtable.functions.tokens import tokenize
from tagtable.session import ensure_checkpoint_dir
from tagtable.sources.fixtures import SENTENCES_SQL, predictor_tags


def annotate_stream(sentences: DataFrame, key: str = "id") -> DataFrame:
    """Normalise, tokenise and rule-correct a (streaming) sentence table;
    tags come from the deterministic fixture model expressed as a Column."""
    t = sentences.select(key, tokenize(normalize("text")).alias("tokens"),
                         tokenize(normalize("lemma_text")).alias("lemmas"))
    t = t.withColumn("model_tags", predictor_tags(key, "tokens"))
    return t.withColumn("fixed_tags", fix_tags("tokens", "lemmas", "model_tags"))


def sentences_stream(spark: SparkSession, folder: str, pattern: str = "orders*.parquet",
                     max_files_per_trigger: int = 1) -> DataFrame:
    """Sentences derived from ``orders`` files arriving in ``folder``."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    orders = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .option("pathGlobFilter", pattern).parquet(folder)
              .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"))
    return spark.sql(SENTENCES_SQL, orders=orders)


def start_label_counts(spark: SparkSession, folder: str, query_name: str = "label_counts",
                       sink: str = "memory", checkpoint: str | None = None):
    """Running count of tokens per corrected label (the flagship, streamed).
    Complete output mode; the checkpoint lives under the session's shared
    ``spark.checkpoint.dir`` unless one is given."""
    counts = (annotate_stream(sentences_stream(spark, folder))
              .select(F.explode_outer("fixed_tags").alias("tag")).filter(F.col("tag").isNotNull())
              .groupBy("tag").agg(F.count(F.lit(1)).alias("n")))
    ckpt = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "streams", query_name)
    return (counts.writeStream.outputMode("complete").format(sink).queryName(query_name)
            .option("checkpointLocation", ckpt).start())
