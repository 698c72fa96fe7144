"""Normalisation rules, tokenising, list-repr parsing."""
from pyspark.sql import functions as F

from tagtable.functions.normalize import normalize
from tagtable.functions.tokens import parse_int_repr, parse_list, repr_tokens_to_sentence, tokenize

GOLDEN = [
    ("Od 1.1.2020 do 31. 12. 2021 NBS [ 12 ] zaznamenala rast o 3,5% a 25%.",
     "Od 1 1 2020 do 31 12 2021 NBS zaznamenala rast o 3.5 % a 25 %"),
    ("Cena je 1 234 567 eur, t.j. 12 345 mil. €; info: abc@nbs.sk alebo tel:02",
     "Cena je 1234567 eur t.j. 12345 mil euro info abc @ nbs sk alebo tel:02"),
    ("Česko-Slovenska makro-ekonomický e-mail 08:30 -5,2 p. b. rast.",
     "Československa makroekonomický email 08:30 až 5.2 p.b. rast"),
    ("firma a. s. Johnson & Johnson d.c. o.c.p . 2010 - 2015 (pozri „NBS“) … x .",
     "firma a.s. Johnson&Johnson d.c. o.c.p. 2010 až 2015 pozri NBS x."),
    ("desaťtisíc eur a 3.5 -7 +8,1% 1 000 000 ks", "10 tisíc eur a 3 5 až 7 +8.1 % 1000000 ks"),
    ("5-7 %, 1,2,3 .. a , . b", "5 až 7 % 1.2 3 a b"),
    ("Test: koniec:", "Test koniec:"),
    (" 1 000 Eur a 2 500 eur 10 000 00", "1000 Eur a 2500 eur 1000000"),
]


def test_golden_normalisation(spark):
    df = spark.createDataFrame(GOLDEN, "inp string, exp string")
    rows = df.select("exp", normalize("inp").alias("got")).collect()
    for r in rows:
        assert r.got == r.exp


def test_tokenize_drops_empty(spark):
    df = spark.createDataFrame([("abc @  def",)], "t string")
    assert df.select(tokenize("t").alias("x")).first().x == ["abc", "@", "def"]


def test_repr_parsing(spark):
    df = spark.createDataFrame(
        [("""['a', "it's", 'č']""", "[0 0  1\n 2]", "['V' 'roku' '1998']"),
         ("['a\\'b']", "[3]", "['x']"), ("['a\\xa0b']", "[4]", "['y']")], "l string, n string, t string")
    rows = df.select(parse_list("l").alias("l"), parse_int_repr("n").alias("n"),
                     repr_tokens_to_sentence("t").alias("t")).collect()
    assert rows[0].l == ["a", "it's", "č"]
    assert rows[0].n == [0, 0, 1, 2]
    assert rows[0].t == "V roku 1998"
    assert rows[1].l == ["a'b"]
    assert rows[2].l == ["a\xa0b"]  # an escape JSON lacks
