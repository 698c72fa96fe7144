"""The training-data pipeline: each stage takes (spark, docs, sf_dir) and returns what the next one reads.

Language ID rejects texts without a clear language, the Jaccard join leaves one document of each group, the secret
scan masks live-looking credentials, the mix takes documents by source weights (a document may come more than once)
and best-fit packing returns the pieces with their sequences. Nulls, ties, repeated rows and empty tables are treated as the
operators say; other columns of the documents pass through all stages but the last. ``run`` settles each stage's result
in the shared folder before the next one reads it, so no stage is computed again and all passes read the same rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tagtable.llm import jaccard_join, language_id, mixing, packing, secret_scan
from tagtable.llm.common import settle


def identify_language(spark, docs, sf_dir):
    return language_id.keep_identified(docs, docs.where(~language_id.held_out(F.col("doc_id"))))


def drop_near_duplicates(spark, docs, sf_dir):
    return jaccard_join.one_per_group(docs)


def mask_secrets(spark, docs, sf_dir):
    return secret_scan.redact(docs)


def mix_sources(spark, docs, sf_dir):
    return mixing.mix_documents(docs)


def pack_sequences(spark, docs, sf_dir):
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]
ORACLE_SQL = None  # learned models, MinHash groups and a tokenizer: tested against brute force instead


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
