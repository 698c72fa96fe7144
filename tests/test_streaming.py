"""The flagship aggregate as a stream gives the batch answer."""
from pyspark.sql import functions as F

from tagtable.streaming.annotate import start_label_counts

SF = "/root/testdata/sf0.001"


def test_stream_label_counts_match_batch(spark):
    from tagtable.plans.queries import fix_tag_counts
    from tagtable.functions.labels import label_id

    import tempfile

    # A fresh checkpoint: resuming an old one would rightly see no new files.
    ckpt = tempfile.mkdtemp(prefix="stream-ckpt-")
    q = start_label_counts(spark, SF, query_name="label_counts_test", checkpoint=ckpt)
    try:
        q.processAllAvailable()
        got = {r.tag: r.n for r in spark.sql("SELECT tag, n FROM label_counts_test").collect()}
    finally:
        q.stop()
    want = {r.tag: r.n for r in fix_tag_counts(spark, SF).select(label_id("label").alias("tag"), "n").collect()}
    assert got == want
