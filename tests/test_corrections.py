"""Review blocks and corrections round trip."""
import os
import tempfile

from pyspark.sql import functions as F

from tagtable.operators import corrections as C


def _blocks(spark, texts):
    return spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "block string, seq long")


def test_last_correction_wins_and_rejects(spark):
    blocks = [
        "Row: 1\nID: 0\nToken Index: 8\nWord: NBS\nNER Tag: 0 -- B-Organization",
        "Row: 1\nID: 0\nToken Index: 8\nWord: NBS\nNER Tag: B-Organization -- I-Organization",
        "Row: 8\nID: 7\nToken Index: 3\nWord: x\nNER Tag: 0 -- ",
        "   ",
    ]
    parsed = C.parse_corrections(_blocks(spark, blocks))
    st = {r.seq: r.status for r in parsed.collect()}
    assert st == {0: "ok", 1: "ok", 2: "unfilled"}  # blank block skipped
    sent = spark.createDataFrame([(0, [0] * 10), (7, [1, 1, 1, 1])], "id long, fixed_tags array<int>")
    out = {r.id: r.fixed_tags for r in C.apply_corrections(sent, parsed).collect()}
    assert out[0][8] == 4 and out[7] == [1, 1, 1, 1]


def test_dump_and_read_back_is_identity(spark):
    df = spark.createDataFrame([(1, 5, ["V", "roku"], [0, 7])], "row long, id long, tokens array<string>, fixed_tags array<int>")
    blocks = C.review_blocks(df, "row")
    path = os.path.join(tempfile.mkdtemp(prefix="review-"), "blocks")
    C.write_review_blocks(blocks, path)
    back = C.parse_corrections(C.read_correction_blocks(spark, path))
    assert sorted((r.id, r.token_index, r.status) for r in back.collect()) == [(5, 0, "unfilled"), (5, 1, "unfilled")]
    filled = blocks.select(F.concat("block", F.lit("B-Date")).alias("block"), F.lit(1).alias("seq"))
    got = C.parse_corrections(filled).collect()
    assert {(r.id, r.token_index, r.new_tag) for r in got} == {(5, 0, 7), (5, 1, 7)}


def _write(path, blocks, end="\n"):
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write((end + end).join(b.replace("\n", end) for b in blocks) + end)


def _block(idx, label, word="x", row=0):
    return f"Row: 1\nID: {row}\nToken Index: {idx}\nWord: {word}\nNER Tag: 0 -- {label}"


def test_last_correction_wins_over_files_of_any_size(spark):
    """The larger later file wins although the scan may read it first; a list of paths sets the order itself."""
    d = tempfile.mkdtemp(prefix="order-")
    _write(os.path.join(d, "part-0"), [_block(3, "B-Person")])
    _write(os.path.join(d, "part-1"), [_block(3, "B-Date")] + [_block(i, "B-Person", "y" * 200, 9) for i in range(400)])
    sent = spark.createDataFrame([(0, [0] * 5)], "id long, fixed_tags array<int>")
    one = C.apply_corrections(sent, C.parse_corrections(C.read_correction_blocks(spark, d))).first().fixed_tags
    two = C.apply_corrections(sent, C.parse_corrections(C.read_correction_blocks(
        spark, [os.path.join(d, "part-1"), os.path.join(d, "part-0")]))).first().fixed_tags
    names = ["B-Date", "B-Person"]
    ids = {r.n: r.i for r in spark.createDataFrame([(n,) for n in names], "n string").select("n", C.label_id("n").alias("i")).collect()}
    assert one[3] == ids["B-Date"] and two[3] == ids["B-Person"]


def test_crlf_files_parse_like_others(spark):
    d = tempfile.mkdtemp(prefix="crlf-")
    path = os.path.join(d, "f.txt")
    _write(path, [_block(1, "B-Person"), _block(2, "")], "\r\n")
    parsed = C.parse_corrections(C.read_correction_blocks(spark, path))
    got = parsed.collect()
    assert sorted((r.token_index, r.new_label, r.status) for r in got) == [(1, "B-Person", "ok"), (2, "", "unfilled")]
    assert C.rejects(parsed).count() == 1


def test_duplicate_ids_are_reported(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "id long")
    assert [tuple(r) for r in C.duplicate_ids(df).collect()] == [(1, 2)]
