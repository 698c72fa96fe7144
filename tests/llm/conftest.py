import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, size=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="session")
def documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, copies, near copies, shared passages."""
    base = words(120, 1)
    near = base.split()
    near[60] = "changed"
    passage = words(60, 2)
    rows = [
        (0, base, "en", "src1"), (1, base, "en", "src1"), (2, " ".join(near), "en", "src2"),
        (3, words(30, 3) + " " + passage + " " + words(30, 4), "fr", "src2"), (4, words(20, 5) + "\n" + passage, "fr", None),
        (5, None, "en", "src1"), (6, "", None, "src3"), (7, " \t\n ", "de", "src3"), (8, "123 456 -- !", "de", "src3"),
        (9, "one two", "de", "src4"), (10, "one two", "de", "src4"), (11, words(30_000, 6, 5000), "es", "src1"),
        (12, "same row " * 10, "en", "src1"), (12, "same row " * 10, "en", "src1"), (None, base, "en", "src1"), (None, None, None, None),
        (13, "éè един \U0001f600 word", "es", ""), (14, "x " * 500, "en", "src2"), (15, words(12, 1), "en", "src5"), (16, words(13, 1), "en", "src5"),
    ]
    rows += [(100 + i, words(50 + i, 50 + i), ("en", "fr", "de", "es")[i % 4], f"src{i % 3}") for i in range(30)]
    data = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(documents):
    """The documents with more columns, named as the operators' own."""
    from pyspark.sql import functions as F

    names = "chunk row_key digest size score spans label copies target source_size rank lang_pred ambiguous held_out kept n_words".split()
    return documents.withColumns({n: F.lit("extra") for n in names})


@pytest.fixture(scope="session")
def vectors(spark):
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(400)]
    rows += [(400 + i, list(rows[20][1])) for i in range(30)]  # ties with row 20
    rows += [(500, None), (501, [None] + [1.0] * 15), (502, [float("nan")] * 16), (503, [float("inf")] + [0.0] * 15), (504, [0.0] * 16),
             (None, [1.0] * 16), (505, []), (506, [1.0, 2.0]), (40, list(rows[40][1]))]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)


@pytest.fixture(scope="session")
def no_vectors(spark):
    return spark.createDataFrame([], "vec_id long, embedding array<float>")
