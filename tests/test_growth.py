"""Work a row, and tasks that grow in number with the rows."""

import random
import time

from pyspark.sql import functions as F

from tagtable.constants import NORMALIZATION_RULES
from tagtable.functions.normalize import normalize
from tagtable.functions.rules import NUMBER_PREFIX, TIME_PREFIX, fix_tag
from tagtable.operators.metrics import entity_metrics
from tagtable.sources.tables import spread

MARKS = list("aAbBcdDopsz019 .,:;-–%+@&'\"[]()/|!?…€`‘“„áčŽžě_^\\\t\n\r\x0b\x1c\x85\xa0   　᠎​٣𝟏😀$") + [
    "  ", "12", " 678", "desaťtisíc", "Česko Slovensk", "e mail", "o.c.p", "p.b", "D.c", "a. s.", ": ", "1.2.2020", "[12]", " 1 234 567", "cd:ef", "5%", "1,5"]


def rule_by_rule(text):
    return normalize(F.col(text), tuple(NORMALIZATION_RULES) + (("x{9}", "x{9}"),))  # other rules than the fixed ones run as written


def test_fixed_rules_give_the_text_of_the_rules_as_written(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(MARKS) for _ in range(rng.randrange(20))) for _ in range(20000)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.filter(~normalize("t").eqNullSafe(rule_by_rule("t"))).count() == 0


def test_fixed_rules_cost_less_than_the_rules_as_written(spark):
    text = "V roku 1996 1. januára o 12:30 zaplatila NBS firme Nova a. s. 173 665 eur (3,4%) [5]. "
    df = spark.range(0, 40000, 1, 4).select(F.concat(F.lit(text), F.col("id").cast("string")).alias("t"))

    def seconds(c):
        best = 1e9
        for _ in range(3):
            t = time.time()
            df.select(c.alias("x")).write.format("noop").mode("overwrite").save()
            best = min(best, time.time() - t)
        return best

    assert seconds(normalize("t")) < 0.8 * seconds(rule_by_rule("t"))


def test_dots_references_and_spaces_side_by_side_give_the_text_of_the_rules_as_written(spark):
    rng = random.Random(3)
    few = list("aé5. ,%ab1[]:(") + [". ", " .", "..", "[1]", ", ", " p.b.", "o.c.p.", "d.c.", "1 234", " 12 345 ", "a. s.", "x&y", "e@f g", "-", "  "]
    texts = [".1 234-:,  .: .", "b.1:[:...o.c.p...a", "5:[1]: .d.c.", "é5a . ab .", ", [1].", "a. [12] ."]  # spaces left by a colon before a dot
    df = spark.createDataFrame([(t,) for t in texts + ["".join(rng.choice(few) for _ in range(rng.randrange(12))) for _ in range(8000)]], "t string")
    assert df.filter(~normalize("t").eqNullSafe(rule_by_rule("t"))).count() == 0


def test_tag_rules_try_regular_expressions_only_on_words_that_begin_as_numbers(spark):
    words = ["1", "+1.5x", "-٣", "٣٣:٣٣", "12:30", "𝟏", "+", "a1", "%", ":", ":1", "NBS", "", None, "š9", "/12:30", "\u066012", "ž", "９"]
    df = spark.createDataFrame([(w, t) for w in words for t in range(14)], "w string, t int")
    got = fix_tag(F.col("w"), F.lit("x"), F.lit("rok"), F.lit("x"), F.col("t"))
    as_written = (F.when(F.col("w").isin("NBS", "NAKA") & ~F.col("t").isin(3, 4), 3).when(F.col("w").rlike(TIME_PREFIX), 9)
                  .when(F.col("w").rlike(NUMBER_PREFIX), 7).otherwise(F.col("t")))
    assert df.filter(~got.eqNullSafe(as_written)).count() == 0
    plan = df.select(got)._jdf.queryExecution().optimizedPlan().toString()
    assert "< :) OR" in plan


def test_entity_counts_are_computed_once_a_row(spark):
    df = spark.createDataFrame([([1, 2, 0], [1, 0, 0])], "g array<int>, p array<int>")
    plan = entity_metrics(df, "g", "p", ids=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_intersect") == 1


def test_tasks_grow_with_the_rows(spark):
    df = spark.range(0, 1000, 1, 1)
    assert spread(df, "id", 2, rows_per_task=50).rdd.getNumPartitions() == 20
    assert spread(df, "id", 2, rows_per_task=5000).rdd.getNumPartitions() == 2
