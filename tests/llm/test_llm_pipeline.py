"""The pipeline: each stage's decisions take effect and clean documents stay."""
import corpus_pipeline
from tagtable.llm import jaccard_join, packing


def test_stages(spark, documents, tmp_path_factory):
    docs, sizes = documents, []
    tmp = tmp_path_factory.mktemp("stages")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, "")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == documents.columns, name
        out.write.parquet(f"{tmp}/{k}")
        docs = spark.read.parquet(f"{tmp}/{k}")
        sizes.append(docs.count())
    after_language = spark.read.parquet(f"{tmp}/0")
    assert after_language.where("text is null or doc_id in (6, 7, 8)").count() == 0
    assert after_language.where("doc_id >= 100").count() == 30  # clean documents stay
    ids = [r.doc_id for r in spark.read.parquet(f"{tmp}/1").collect()]
    assert 0 in ids and not {1, 2, 10} & set(ids) and ids.count(12) == 1 and set(range(100, 130)) <= set(ids)
    mixed = spark.read.parquet(f"{tmp}/3")
    assert mixed.count() > 0 and docs.where("piece = 0").count() == mixed.count()
    assert packing.SEQUENCE >= max(r[0] for r in docs.groupBy("sequence_id").sum("length").select("sum(length)").collect())


def test_run_returns_the_last_stage(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out.columns)


def test_run_computes_each_stage_once(spark, monkeypatch):
    """What a stage hands on is stored: reading it twice runs nothing of that stage again."""
    rows = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            rows.add(b.num_rows)
            yield b

    stages = [("counted", lambda spark, docs, sf_dir: docs.mapInArrow(counted, docs.schema)), ("twice", lambda spark, docs, sf_dir: docs.union(docs))]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    before = rows.value
    assert out.count() > 0 and len(out.collect()) > 0 and rows.value == before > 0


def test_the_kept_row_does_not_depend_on_row_order(spark, documents):
    """Rows equal in doc_id and text with another source: the same one stays in any order of the rows."""
    data = [(1, "one text of several words", "en", s, None) for s in ("c", "a", "b")]
    for rows in (data, data[::-1], data[1:] + data[:1]):
        kept = jaccard_join.one_per_group(spark.createDataFrame(rows, documents.schema).coalesce(1)).collect()
        assert [r.source for r in kept] == ["a"]


def test_empty_pipeline(spark, no_documents):
    docs = no_documents
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.collect() == []
