"""Tokenising and list-text parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtable.constants import WS, WS_CLASS_BODY
from tagtable.functions.arrays import let


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(c: Column | str) -> Column:
    """Split on single spaces and drop empty pieces (C2, quirk Q5)."""
    return F.filter(F.split(_col(c), " "), lambda t: t != F.lit(""))


def join_words(c: Column | str, sep: str = " ") -> Column:
    """Join an array of words with a separator."""
    return F.array_join(_col(c), sep)


def strip_brackets(c: Column | str) -> Column:
    c = _col(c)
    return F.substring(c, 2, F.greatest(F.length(c) - 2, F.lit(0)))


def repr_tokens_to_sentence(c: Column | str) -> Column:
    """Turn a numpy repr of a token list (``['a' 'b']``) into ``a b``.
    The character class also swallows ``+`` on purpose."""
    cleaned = F.regexp_replace(strip_brackets(c), "['" + WS_CLASS_BODY + "+]+", " ")
    return F.regexp_replace(cleaned, "^ +| +$", "")


def parse_int_repr(c: Column | str) -> Column:
    """Parse a numpy repr int list such as ``[0 0  1\\n 2]`` to ARRAY<INT> (C4)."""
    spaced = F.regexp_replace(strip_brackets(c), WS + "+", " ")
    trimmed = F.regexp_replace(spaced, "^ | $", "")
    return F.transform(F.filter(F.split(trimmed, " "), lambda t: t != ""), lambda t: t.try_cast("int"))


# A Python string literal, of three quotes or in one line; possessive, so matching is linear and keeps no stack however long
# the text. Three quotes in a row always open a literal of three quotes, never an empty one and another.
_STRING = (r"(?:'{3}[^'\\\x00]*+(?:(?:\\[^\x00]|'(?!''))[^'\\\x00]*+)*+'{3}|" r'"{3}[^"\\\x00]*+(?:(?:\\[^\x00]|"(?!""))[^"\\\x00]*+)*+"{3}|'
           r"'(?!'')[^'\\\n\r\x00]*+(?:\\[^\r\x00][^'\\\n\r\x00]*+)*+'|" r'"(?!"")[^"\\\n\r\x00]*+(?:\\[^\r\x00][^"\\\n\r\x00]*+)*+")')
_GAP = r"(?:[ \t\f\r\n]|\\\n)*+"
_STRINGS = f"{_STRING}(?:{_GAP}{_STRING})*+"  # strings side by side are one
_NUMBER = r"[+-]?+(?:0++|[1-9][0-9]*+)(?![0-9_.xobejXOBEJ])"
_ESCAPE = (r"[^\\]++|\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}|\\[0-7]{1,3}|(?s:\\.)")
# Escapes that name no character a string column can hold: cut short, a lone surrogate, beyond Unicode, or by name.
_BAD_ESCAPE = (r"^(?:[^\\]++|\\[^xuUN])*+\\(?:N|x(?![0-9a-fA-F]{2})|u(?![0-9a-fA-F]{4})|u[dD][89a-fA-F]|U(?!00(?:0[0-9a-fA-F]|10)[0-9a-fA-F]{4})"
               r"|U0000[dD][89a-fA-F])")
_PLAIN_ESCAPES = {"n": "\n", "r": "\r", "t": "\t", "a": "\a", "b": "\b", "f": "\f", "v": "\v", "\\": "\\", "'": "'", '"': '"', "\n": ""}


def _character(hex_digits: Column) -> Column:
    # a leading byte order mark is dropped in decoding, so U+FEFF itself needs one before it
    return F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(hex_digits, 8, "0"))), "UTF-32")


def _unescape(part: Column) -> Column:
    """One run without a backslash, or one escape, as the characters it stands for."""
    kind = F.substring(part, 2, 1)
    plain = F.create_map(*[F.lit(x) for kv in _PLAIN_ESCAPES.items() for x in kv])
    return (F.when(~part.startswith("\\"), part)
            .when(kind.isin("x", "u", "U"), _character(F.substring(part, 3, 8)))
            .when(kind.rlike("[0-7]"), _character(F.conv(F.substring(part, 2, 3), 8, 16)))
            .otherwise(F.coalesce(F.try_element_at(plain, kind), part)))  # an unknown escape stands for itself


def _literal_value(body: Column) -> Column:
    """The text of a literal between its quotes; null where an escape names no character."""
    parts = F.regexp_extract_all(body, F.lit("(" + _ESCAPE + ")"), 1)
    decoded = F.when(body.rlike(_BAD_ESCAPE), None).otherwise(F.array_join(F.transform(parts, _unescape), ""))
    return F.when(F.contains(body, F.lit("\\")), decoded).otherwise(body)


def parse_list(c: Column | str, element_type: str = "string") -> Column:
    """Parse the text of a Python list (``['a', "it's", '\\x07']``, ``[0, 3]``) to an array (C5), without ``eval``.

    For strings: both quotes, one or three of them, every escape but ``\\N{...}``, strings side by side, ``None`` (a null element), a
    trailing comma, line ends between elements. For integer types: decimal numbers and ``None``. Everything ``repr``
    writes for a list of strings, or of integers of the type, is read as Python reads it. Other texts give null, which callers route to a rejects table
    (``split_rejects``), and so do the few a string column cannot hold: escapes for lone surrogates, and numbers too large."""
    c = _col(c)
    text = element_type == "string"
    element = f"(?:{_STRINGS if text else _NUMBER}|None)"
    whole = rf"^(?:[ \t]*+|\n*+)\[{_GAP}(?:{element}{_GAP}(?:,{_GAP}{element}{_GAP})*+(?:,{_GAP})?+)?+\]{_GAP}$"
    found = F.regexp_extract_all(c, F.lit(f"({element})"), 1)
    if text:
        pieces = lambda e: F.regexp_extract_all(e, F.lit(f"({_STRING})"), 1)
        short = lambda q: F.substring(q, F.lit(2), F.length(q) - 2)
        long = lambda q: F.regexp_replace(F.substring(q, F.lit(4), F.length(q) - 6), "\r\n?", "\n")
        body = lambda q: F.when(q.startswith("'''") | q.startswith('"""'), long(q)).otherwise(short(q))
        # concat is null if any piece is: null for None and for bad literals, which a second look tells apart
        value = lambda e: F.when(e != "None", F.aggregate(pieces(e), F.lit(""), lambda a, q: F.concat(a, _literal_value(body(q)))))
    else:
        value = lambda e: F.when(e != "None", e.try_cast(element_type))
    values = F.transform(found, lambda e: F.struct(value(e).alias("v"), (e == "None").alias("none")))
    checked = let({"x": values}, lambda v: F.when(
        ~F.exists(v["x"], lambda e: e["v"].isNull() & ~e["none"]), F.transform(v["x"], lambda e: e["v"])))
    return F.when(c.rlike(whole), checked)


def split_rejects(df: DataFrame, raw: str, parsed: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose list text was parsed, and the rejects (C5): rows with a raw
    value but no parsed one."""
    bad = F.col(raw).isNotNull() & F.col(parsed).isNull()
    return df.filter(~bad), df.filter(bad)


def to_token_rows(df: DataFrame, key: str, arrays: dict[str, str], pos: str = "idx") -> DataFrame:
    """Sentence form -> token form: one row per position.

    ``arrays`` maps output column -> array column; all are zipped by position
    so a shorter array yields nulls rather than shifting later rows."""
    names = list(arrays)
    zipped = F.arrays_zip(*[F.col(arrays[n]).alias(n) for n in names])
    return (
        df.select(key, F.posexplode(zipped).alias(pos, "_z"))
        .select(key, pos, *[F.col("_z")[n].alias(n) for n in names])
    )


def to_sentence_rows(df: DataFrame, key: str, pos: str, columns: list[str]) -> DataFrame:
    """Token form -> sentence form: arrays ordered by position. Groups by the
    sentence key only, so every group is one sentence (bounded)."""
    s = F.sort_array(F.collect_list(F.struct(pos, *columns)))
    return df.groupBy(key).agg(s.alias("_s")).select(
        key, *[F.col("_s")[c].alias(c) for c in columns]
    )
