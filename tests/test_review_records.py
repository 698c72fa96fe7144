"""Review files read a block a record, and blocks parsed by plain expressions, give what lines and regular expressions give."""

import random

from pyspark.sql import functions as F

from tagtable.operators import corrections as C
from tagtable.sources.lines import file_lines, line_runs


def runs_of(text):
    return [r.strip("\n") for r in "\n".join("\0" if not x.strip(" \t") else x for x in text.replace("\r\n", "\n").split("\n")).split("\0") if r.strip("\n")]


def test_blocks_of_evenly_parted_files_over_borders_of_splits(spark, tmp_path):
    rng = random.Random(5)
    even = ["\n\n".join("\n".join(rng.choice(["a", "bc d", "é" * 9, "x" * 40]) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(1, 25))) + rng.choice(["", "\n", "\n\n"])
            for _ in range(6)]
    odd = ["a\n\n\nb\n\nc", "\na\n\nb", "a\n\nb\n\n\n", "a\r\n\r\nb", "a\n \nb", "a\n\t\n\nb\n\nc\n\n\n\nd", "", "\n\n", "\n\n\n\n"]
    for n, text in enumerate(even + odd):
        (tmp_path / f"p{n:02}").mkdir()
        (tmp_path / f"p{n:02}" / "f.txt").write_text(text, newline="")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        for n, text in enumerate(even + odd):
            for limit in (1, 2, 3, 7, 50) if len(text) < 30 else (7, 50):
                spark.conf.set("spark.sql.files.maxPartitionBytes", f"{limit}b")
                blocks = C.read_correction_blocks(spark, str(tmp_path / f"p{n:02}"))
                assert [r.block for r in blocks.orderBy("seq").collect()] == runs_of(text), (n, limit, text)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_of_both_kinds_are_read_in_the_order_of_their_paths(spark, tmp_path):
    for nth, text in enumerate(["a\r\n\r\nb", "c\n\nd", "e\n\n\nf"]):
        (tmp_path / f"{nth}.txt").write_text(text, newline="")
    paths = [str(tmp_path / f"{nth}.txt") for nth in range(3)]
    assert [r.block for r in C.read_correction_blocks(spark, paths).orderBy("seq").collect()] == list("abcdef")
    assert [r.seq.nth for r in C.read_correction_blocks(spark, paths).orderBy("seq").collect()] == [0, 0, 1, 1, 2, 2]


def test_files_written_here_are_read_without_lines_in_python_or_a_shuffle(spark, tmp_path):
    blocks = spark.range(50).select(C.block_text(F.col("id"), F.col("id"), F.lit(0), F.lit("w"), F.lit("0"), F.lit("B-Date")).alias("block"))
    C.write_review_blocks(blocks, str(tmp_path / "out"))
    got = C.read_correction_blocks(spark, str(tmp_path / "out"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Exchange" not in plan
    old = line_runs(file_lines(spark, str(tmp_path / "out")), F.col("line") == "", "block").select("block")
    assert got.count() == 50 and got.select("block").exceptAll(old).count() == 0


def test_fields_of_odd_blocks(spark):
    rng = random.Random(6)
    marks = [" ", "\t", "\n", "\n", "\x0b", "\r", "\x85", "12", "x", "--", "0", "B-Date", ":", "ID: 7", "-3", "\x01", "99999999999"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(12))) for _ in range(6000)] + [None, "", " \n", "a\nID: 5\nToken Index: 2\n-- I-Date "]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, block string")
    lines = F.split(F.regexp_replace("block", r"^\s+|\s+$", ""), "\n")
    number = lambda i, kind: F.regexp_extract(F.get(lines, i), r"(\S+)\s*$", 1).try_cast(kind)
    want = df.filter(F.regexp_replace("block", r"^\s+|\s+$", "") != "").select(
        "n", number(1, "bigint").alias("id"), number(2, "int").alias("token_index"), F.trim(F.substring_index(F.get(lines, F.size(lines) - 1), "--", -1)).alias("new_label"))
    got = C.parse_corrections(df).select("n", "id", "token_index", "new_label")
    assert got.exceptAll(want).collect() == [] and want.exceptAll(got).collect() == []
    assert got.filter("id is not null").count() > 100
