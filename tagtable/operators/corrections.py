"""Human review round trip: dump one block per token, read filled-in blocks
back, apply them with the last correction winning (K4, S7, J1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtable.functions.arrays import computed_once, let
from tagtable.functions.labels import label_id, label_name
from tagtable.sources.lines import evenly_parted, file_lines, line_runs, record_runs

BLOCK_SEP = "\n\n"
BLANK = r"^[ \t]*$"


def review_blocks(df: DataFrame, row: str, key: str = "id", tokens: str = "tokens",
                  tags: str = "fixed_tags") -> DataFrame:
    """One review block per token (K4):
    ``Row: r / ID: id / Token Index: i / Word: w / NER Tag: label -- ``.
    ``row`` is the sentence's 1-based row number (see ``positions``)."""
    rows = review_rows(df, row, key, tokens, tags)
    block = block_text(F.col(row), F.col(key), F.col("token_index"), F.col("word"), label_name(F.col("tag")))
    return rows.select(key, "token_index", block.alias("block"))


def review_rows(df: DataFrame, row: str, key: str = "id", tokens: str = "tokens",
                tags: str = "fixed_tags") -> DataFrame:
    """Token rows ``row, key, token_index, word, tag`` of sentence-form input."""
    z = F.arrays_zip(F.col(tokens).alias("w"), F.col(tags).alias("t"))
    return (df.select(row, key, F.posexplode_outer(z).alias("token_index", "z"))
            .filter(F.col("z").isNotNull())
            .select(row, key, F.col("token_index").cast("int").alias("token_index"),
                    F.col("z.w").alias("word"), F.col("z.t").alias("tag")))


def block_text(row: Column, key: Column, idx: Column, word: Column, label: Column,
               new_label: Column | None = None) -> Column:
    """The text of one review block; ``new_label`` fills in the reviewer's answer."""
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Row: "), row.cast("string")),
        F.concat(F.lit("ID: "), key.cast("string")),
        F.concat(F.lit("Token Index: "), idx.cast("string")),
        F.concat(F.lit("Word: "), word),
        F.concat(F.lit("NER Tag: "), label, F.lit(" -- "), new_label if new_label is not None else F.lit("")),
    )


def write_review_blocks(blocks: DataFrame, path: str, crlf: bool = False) -> None:
    """Blocks parted by a blank line, as the review file is laid out."""
    blocks.select("block").write.mode("overwrite").option("lineSep", "\r\n\r\n" if crlf else BLOCK_SEP).text(path)


def read_correction_blocks(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Read filled-in review files: one record per blank-line separated block.

    Files are read as lines, with LF, CRLF or both as line ends, so one large file is read by as many tasks as it
    has splits. A block is a run of lines between blank ones and may lie across a split's border; blocks are put together where
    their lines are read, and only those at borders are shuffled (``line_runs``). Files with LF and one empty line between blocks, as
    ``write_review_blocks`` makes them, are read a block a record (``record_runs``). ``seq`` orders blocks for the
    last-one-wins rule: by the file's place in ``paths``, then by its path (the files of one folder), then by the place in the file."""
    def blank(line: Column) -> Column:
        plain = (line >= "!") & (line < "\x7f")  # begins with an ASCII character that is no white space
        return F.when(line == "", True).when(plain, False).otherwise(line.rlike(BLANK))

    every = dict(enumerate([paths] if isinstance(paths, str) else paths))
    even = evenly_parted(spark, every, blank)
    rest = {nth: path for nth, path in every.items() if nth not in even}
    found = [record_runs(spark, even, "block")] if even else []
    found += [line_runs(file_lines(spark, rest), blank(F.col("line")), "block")] if rest else []
    blocks = found[0].unionByName(found[1]) if len(found) > 1 else found[0]
    return blocks.select("block", F.struct("nth", "file", "start", "place").alias("seq"))


def duplicate_ids(df: DataFrame, key: str = "id") -> DataFrame:
    """Ids that occur more than once, with their number of rows (Q11). A
    correction names one row, so ``apply_corrections`` needs unique ids."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def rejects(parsed: DataFrame) -> DataFrame:
    """Parsed blocks that change nothing: unfilled or bad ones."""
    return parsed.filter(F.col("status") != "ok")


_SPACE = " \t\n\x0b\f\r"


def _odd_end(c: Column) -> Column:
    """Ends in a line terminator that a regular expression's ``$`` knows and its white space does not."""
    return F.endswith(c, F.lit("\x85")) | F.endswith(c, F.lit("\u2028")) | F.endswith(c, F.lit("\u2029"))


def _stripped(c: Column) -> Column:
    """Without white space at both ends; only the ends of the text are looked at."""
    return F.when(_odd_end(c), F.regexp_replace(c, r"^\s+|\s+$", "")).otherwise(F.btrim(c, F.lit(_SPACE)))


def _last_word(line: Column) -> Column:
    """Last whitespace-separated word of a line."""
    plain = F.substring_index(F.rtrim(F.translate(line, _SPACE[1:], " " * (len(_SPACE) - 1))), " ", -1)
    return F.nullif(F.when(_odd_end(line), F.regexp_extract(line, r"(\S+)\s*$", 1)).otherwise(plain), F.lit(""))


def _last_number(line: Column, kind: str) -> Column:
    """Last word of a line as a number. What follows the last space is that word where it is a number as it is written."""
    plain = F.substring_index(line, " ", -1)
    return F.when(plain.try_cast(kind).cast("string") == plain, plain.try_cast(kind)).otherwise(_last_word(line).try_cast(kind))


def parse_corrections(blocks: DataFrame, block: str = "block") -> DataFrame:
    """Fields of each block: ``id``, ``token_index``, ``new_tag`` and a
    ``status``: 'ok', 'unfilled' (nothing after '--', a reject), 'bad'
    (unknown label or unparsable numbers, a reject). Blank blocks are skipped
    (quirk Q12)."""
    # Steps of their own, each computed once: plain expressions that are compiled, where functions over arrays would be interpreted.
    b, name = F.col("_b"), F.col("new_label")
    text = blocks.withColumn("_b", computed_once(_stripped(F.col(block)))).filter(F.col("_b") != "")
    two = F.substring_index(b, "\n", 2)  # the first two lines; all of the block where it has no more
    second = F.when(F.contains(b, F.lit("\n")), F.substring_index(two, "\n", -1))
    third = F.when(F.octet_length(two) < F.octet_length(b), F.substring_index(F.substring_index(b, "\n", 3), "\n", -1))
    found = text.withColumns({
        "id": computed_once(_last_number(second, "bigint")), "token_index": computed_once(_last_number(third, "int")),
        "new_label": computed_once(F.trim(F.substring_index(F.substring_index(b, "\n", -1), "--", -1)))}).drop("_b")
    tagged = found.withColumn("new_tag", computed_once(label_id(name)))
    status = (F.when(name == "", "unfilled")
              .when(F.col("id").isNull() | F.col("token_index").isNull() | F.col("new_tag").isNull(), "bad").otherwise("ok"))
    return tagged.select(*blocks.columns, "id", "token_index", "new_tag", "new_label", status.alias("status"))


def apply_corrections(df: DataFrame, corrections: DataFrame, key: str = "id", tags: str = "fixed_tags",
                      seq: str = "seq", out: str | None = None) -> DataFrame:
    """Set ``tags[token_index] = new_tag`` per (id, token_index), the last
    correction (highest ``seq``) winning (J1). Corrections are gathered per
    sentence (as many as its reviewers wrote) and joined on the unique key:
    a broadcast when Spark's size estimate allows, a sort-merge join
    otherwise."""
    ok = corrections.filter(F.col("status") == "ok") if "status" in corrections.columns else corrections
    # One grouping per sentence: corrections in order, of which map_from_entries needs the last per index.
    ordered = F.sort_array(F.collect_list(F.struct(F.col("token_index"), F.col(seq).alias("s"), F.col("new_tag"))))
    per_sentence = ok.filter(F.col(key).isNotNull()).groupBy(key).agg(ordered.alias("_all")).select(key, let(
        {"a": F.col("_all")}, lambda v: F.map_from_entries(F.transform(
            F.filter(v["a"], lambda x, i: F.coalesce(F.get(v["a"], i + 1)["token_index"] != x["token_index"], F.lit(True))),
            lambda x: F.struct(x["token_index"], x["new_tag"])))).alias("_fix"))
    joined = df.join(per_sentence, key, "left")
    fixed = let({"t": F.col(tags), "m": F.col("_fix")}, lambda v: F.transform(
        v["t"], lambda t, i: F.coalesce(F.try_element_at(v["m"], i), t)))
    return joined.withColumn(out or tags, F.when(F.col("_fix").isNull(), F.col(tags)).otherwise(fixed)).drop("_fix")
