"""Driver contract: the flagship runs on sf0.001; every query has an oracle
of the library's own."""
import __spark_entry__ as E

ROWS_ONLY = set()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["label", "n"] and len(rows) > 0


def test_every_query_has_an_oracle():
    from tagtable.plans.queries import QUERIES

    assert set(QUERIES) - set(E.oracle_sql()) == ROWS_ONLY
    assert set(E.oracle_sql()) <= set(E.queries())


def test_annotate_with_python_predictor_matches_column_fixture(spark):
    from pyspark.sql import functions as F

    from tagtable.plans.pipelines import annotate_corpus
    from tagtable.operators.tagger import FixturePredictor
    from tagtable.sources import fixtures as fx

    sf = "/root/testdata/sf0.001"
    a = annotate_corpus(fx.sentences(spark, sf), FixturePredictor).select("id", "model_tags", "fixed_tags")
    b = fx.annotated_sentences(spark, sf).select("id", "model_tags", "fixed_tags")
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()
