"""Text files as lines that know their place, so that records of several lines can be put together over the borders of
a file's splits (S1, S7). One large file is read by as many tasks as it has splits; what crosses a border is one
number a split, the sum over the file's earlier splits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPLIT = ("nth", "file", "start")


def _numbered(paths: str | list[str] | dict[int, str]) -> dict[int, str]:
    return paths if isinstance(paths, dict) else dict(enumerate([paths] if isinstance(paths, str) else paths))


def file_lines(spark: SparkSession, paths: str | list[str] | dict[int, str]) -> DataFrame:
    """``nth`` (place in ``paths``, or key), ``file``, ``start`` (the split's place in its file), ``row`` (orders the lines of a
    split) and ``line``, with LF, CRLF or both as line ends."""
    parts = [spark.read.text(path).select(
        F.lit(nth).alias("nth"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
        F.when(F.contains("value", F.lit("\r")), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value")).alias("line"))
        for nth, path in _numbered(paths).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def running_sum(lines: DataFrame, value: Column, out: str) -> DataFrame:
    """Adds the sum of ``value`` over a file's lines up to and with each line."""
    valued = lines.withColumn("_v", value.cast("long"))
    earlier = Window.partitionBy("nth", "file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    before = valued.groupBy(*SPLIT).agg(F.sum("_v").alias("_n")).select(*SPLIT, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*SPLIT).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    summed = valued.withColumn("_in", F.sum("_v").over(inside)).join(before, list(SPLIT))
    return summed.withColumn(out, F.col("_before") + F.col("_in")).drop("_v", "_in", "_before")


def joined_lines(lines: DataFrame, record: str, out: str) -> DataFrame:
    """``nth, file, record`` and the record's lines in order, joined by line ends."""
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "row", "line"))), lambda x: x["line"]), "\n")
    return lines.groupBy("nth", "file", record).agg(text.alias(out))


def line_runs(lines: DataFrame, apart: Column, out: str) -> DataFrame:
    """``nth, file, start, place`` and the text of each run of lines between those where ``apart`` holds, in the order of the
    four columns. ``lines`` are those of ``file_lines``, not moved since: a task has a split's lines in order and puts its
    runs together as it reads. Only what may go on in another split, the first and the last run of each, meets the other
    splits' in a shuffle; for these few the lines are read a second time."""
    schema = "nth int, file string, start long, place long, piece string, text string"

    def assemble(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        at, held, place, closed = None, [], 0, False  # the split, lines of its open run, runs so far, was there a line apart

        def rows(places, pieces, texts):
            one = lambda v, t: pa.repeat(pa.scalar(v, t), len(texts))
            return pa.RecordBatch.from_arrays([one(at[0], pa.int32()), one(at[1], pa.string()), one(at[2], pa.int64()), pa.array(places, pa.int64()),
                                               pa.array(pieces, pa.string()), texts.cast(pa.string())], names=["nth", "file", "start", "place", "piece", "text"])

        def joined(parts):
            return "\n".join(x for p in parts for x in p.to_pylist()) if parts else None

        def last():  # an open run at the end of a split; a split without a line apart is one run that may go on at both ends
            return rows([place], ["last" if closed else "through"], pa.array([joined(held)], pa.string()))

        for b in batches:
            cuts = [0]
            if b.num_rows:
                moved = pc.or_(pc.or_(pc.not_equal(b["nth"][1:], b["nth"][:-1]), pc.not_equal(b["file"][1:], b["file"][:-1])), pc.not_equal(b["start"][1:], b["start"][:-1]))
                cuts += (np.flatnonzero(moved.to_numpy(zero_copy_only=False)) + 1).tolist() + [b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                key = (b["nth"][lo].as_py(), b["file"][lo].as_py(), b["start"][lo].as_py())
                if key != at:
                    if at is not None:
                        yield last()
                    at, held, place, closed = key, [], 0, False
                line = b["line"].slice(lo, hi - lo)
                gap = b["apart"].slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                ends = np.flatnonzero(gap)
                if not len(ends):
                    held.append(line)
                    continue
                first = joined([*held, line.slice(0, int(ends[0]))] if held or ends[0] else [])
                if not closed:
                    yield rows([place], ["first"], pa.array([first], pa.string()))
                elif first is not None:
                    yield rows([place], ["whole"], pa.array([first], pa.string()))
                sizes = np.diff(ends) - 1
                sizes = sizes[sizes > 0]
                inner = line.slice(int(ends[0]), int(ends[-1] - ends[0])).filter(pa.array(~gap[ends[0]:ends[-1]]))
                texts = pc.binary_join(pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), inner), "\n")
                if len(texts):
                    yield rows(place + 1 + np.arange(len(texts)), ["whole"] * len(texts), texts)
                place, closed = place + 1 + len(texts), True
                held = [line.slice(int(ends[-1]) + 1)] if ends[-1] + 1 < len(line) else []
        if at is not None:
            yield last()

    found = lines.select("nth", "file", "start", "line", apart.alias("apart")).mapInArrow(assemble, schema)
    whole = found.filter(F.col("piece") == "whole").select(*SPLIT, "place", F.col("text").alias(out))
    order = Window.partitionBy("nth", "file").orderBy("start", "place")
    run = F.sum((F.col("piece") == "last").cast("long")).over(order)  # a last piece begins a run that first and through pieces go on with
    parts = found.filter(F.col("piece") != "whole").withColumn("_run", run).filter(F.col("text").isNotNull())
    each = F.sort_array(F.collect_list(F.struct("start", "place", "text")))
    over = parts.groupBy("nth", "file", "_run").agg(each.alias("_e")).select(
        "nth", "file", F.get("_e", 0)["start"].alias("start"), F.get("_e", 0)["place"].alias("place"),
        F.array_join(F.transform("_e", lambda x: x["text"]), "\n").alias(out))
    return whole.unionByName(over)


def _records(spark: SparkSession, nth: int, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n\n").text(path).select(
        F.lit(nth).alias("nth"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"), "value")


def evenly_parted(spark: SparkSession, paths: str | list[str] | dict[int, str], apart: Callable[[Column], Column]) -> dict[int, str]:
    """Those of the paths whose files have LF line ends only, and between runs of lines one empty line and no other for which ``apart``
    holds: their runs are what the text reader finds between two line ends. Lines are looked at first, so that no file
    without two line ends in a row but with other blank lines is read as one record."""
    def any_of(df: DataFrame, odd: Column) -> bool:
        return df.agg(F.coalesce(F.bool_or(odd), F.lit(False))).first()[0]

    line, value = F.col("value"), F.col("value")
    other = F.contains(line, F.lit("\r")) | ((line != "") & apart(line))
    return {nth: path for nth, path in _numbered(paths).items() if not any_of(spark.read.option("lineSep", "\n").text(path), other)
            # a record is empty or begins with a line end where there are three line ends or more, or two at the file's start
            and not any_of(_records(spark, nth, path), (value == "") | value.startswith("\n"))}


def record_runs(spark: SparkSession, paths: dict[int, str], out: str) -> DataFrame:
    """What ``line_runs`` gives for ``evenly_parted`` files: each run is one record of the text reader, which reads records
    over the borders of splits, so no line is a row and nothing is shuffled."""
    parts = [_records(spark, nth, path).select(*SPLIT, "place", F.rtrim("value", F.lit("\n")).alias(out)) for nth, path in paths.items()]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.filter(F.col(out) != "")


def csv_records(spark: SparkSession, paths: str | list[str], schema: str, header: bool = True) -> DataFrame:
    """CSV with quoted cells that may hold line ends, in files that are read by many tasks (S1). A line starts a record
    if the quotes before it in its file are even in number; its records are parsed by position. ``_corrupt`` holds the text of a
    record that does not fit the schema (its other cells are read), else null. Line ends in cells become LF; empty lines between records are skipped.
    Quotes in cells are doubled."""
    lines = file_lines(spark, paths)
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    counted = running_sum(lines, quotes, "_quotes")
    starts = ((F.col("_quotes") - quotes) % 2 == 0)
    records = joined_lines(running_sum(counted, starts, "_record").drop("_quotes"), "_record", "_text")
    kept = records.filter(F.col("_text") != "")
    if header:
        kept = kept.filter(F.col("_record") > 1)
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    return kept.select(F.from_csv("_text", f"{schema}, _corrupt string", options).alias("c")).select("c.*")


def split_corrupt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that were read whole, and the texts of the others (rejects)."""
    return rows.filter(F.col("_corrupt").isNull()).drop("_corrupt"), rows.filter(F.col("_corrupt").isNotNull()).select("_corrupt")
