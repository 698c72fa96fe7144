"""What the driver, the disk and a task hold does not grow with the input."""

import random

from pyspark.sql import functions as F

from tagtable.functions.tokens import parse_list
from tagtable.operators import corrections as C
from tagtable.operators import runs as R
from tagtable.plans.pipelines import modelling_dataset


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_table_of_names_or_files_is_broadcast(spark):
    names = spark.range(50).select(F.concat(F.lit("m_V"), "id").alias("Name"))
    files = names.select(F.concat(F.lit("test_"), "Name", F.lit(".csv")).alias("file"))
    found = R.match_models_to_files(names, files)
    assert "Broadcast" not in plan_of(found)
    # the greatest file that contains the name: of m_V1 and m_V10 to m_V19 it is the last
    assert {r.Name: r.file for r in found.collect()}["m_V1"] == "test_m_V19.csv"


def test_blocks_at_borders_of_splits_are_whole_and_lines_are_not_shuffled(spark, tmp_path):
    rng = random.Random(3)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for limit in ("7b", "40b", "1m"):
        folder = tmp_path / limit
        folder.mkdir()
        want = []
        for nth in range(3):
            text = "".join(rng.choice(["a", "bc d", "\n", "\r\n", "\n\n", "\r\n \t\r\n", "x" * 30]) for _ in range(60))
            (folder / f"f{nth}.txt").write_text(text, newline="")
            lines = [x.removesuffix("\r") for x in text.split("\n")]
            runs = "\n".join("\0" if not x.strip(" \t") else x for x in lines).split("\0")
            want += [r.strip("\n") for r in runs if r.strip("\n")]
        try:
            spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            blocks = C.read_correction_blocks(spark, str(folder))
            got = [r.block for r in blocks.orderBy("seq").collect()]
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert got == want
    # blocks that lie inside a split come straight from where they are read
    assert plan_of(blocks).index("MapInArrow") < plan_of(blocks).index("Exchange")


def test_block_fields_as_regular_expressions_find_them(spark):
    rng = random.Random(4)
    marks = [" ", "\t", "\n", "\x0b", "\r", "\x85", " ", "12", "x", "--", "0", "B-Date", ":"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(9))) for _ in range(4000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    assert df.filter(~C._stripped(t).eqNullSafe(F.regexp_replace(t, r"^\s+|\s+$", ""))).count() == 0
    line = df.filter(~t.contains("\n"))
    word = F.nullif(F.regexp_extract(t, r"(\S+)\s*$", 1), F.lit(""))
    assert line.filter(~C._last_word(t).eqNullSafe(word)).select("t").collect() == []


def test_three_quotes_open_one_literal(spark):
    texts = ["['''n']", '["""]\t"]', "['''a'b''']", "['''a\r\nb''' 'c', \"\"\"\"q\\x41\"\"\"]", "['' 'a']", "['''a'''']", "['''" + "x'" * 30_000 + "y''']"]
    want = [None, None, ["a'b"], ["a\nbc", '"qA'], ["a"], None, ["x'" * 30_000 + "y"]]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert [r.v for r in df.select("i", parse_list("t").alias("v")).orderBy("i").collect()] == want


def test_list_texts_are_parsed_once_a_row(spark):
    df = spark.createDataFrame([(1, "['a']", "[0]"), (2, "['a'", "[0]")], "id long, tokens string, fixed_tags string")
    out = modelling_dataset(df, bucket=F.lit(0))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(tokens") == 1
    assert [(r.key, r.tokens) for r in out.collect()] == [(1, ["a"])]
