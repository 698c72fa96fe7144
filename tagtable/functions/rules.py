"""Lexicon and neighbour rules that correct word tags.

The whole correction is one ``transform`` over the sentence's tokens, so it
needs no shuffle: previous/next lemmas are read with ``get`` at i-1 / i+1
inside the same row."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagtable import constants as K
from tagtable.functions.arrays import let

TIME_PREFIX = r"^\p{Nd}{2}:\p{Nd}{2}"
NUMBER_PREFIX = r"^(?:[+-]?\p{Nd}+\.\p{Nd}+|[+-]?\p{Nd})"
ALL_DIGITS = r"^\p{Nd}+$"


@dataclass(frozen=True)
class Lexicons:
    months: tuple[str, ...] = K.MONTH_LEMMAS
    year_prefixes: tuple[str, ...] = K.YEAR_PREFIX_LEMMAS
    money: tuple[str, ...] = K.MONEY_LEMMAS
    percent: tuple[str, ...] = K.PERCENTAGE_LEMMAS
    org_words: tuple[str, ...] = K.ORG_FIX_WORDS
    org_tags: tuple[int, ...] = field(default=(K.TAG_B_ORG, K.TAG_I_ORG))


DEFAULT_LEXICONS = Lexicons()


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_time(word: Column) -> Column:
    """Prefix test, as the original's ``re.match``: ``12:345`` counts."""
    return word.rlike(TIME_PREFIX)


def is_number(word: Column) -> Column:
    """Prefix test: ``25abc`` counts as a number (C7, quirk Q3)."""
    return word.rlike(NUMBER_PREFIX)


def is_digits(word: Column) -> Column:
    """All characters are decimal digits (C10); '' is not."""
    return word.rlike(ALL_DIGITS)


def _maybe_number(word: Column) -> Column:
    """Cheap test that every time and number passes: they begin with a sign or a decimal digit, which lie below ':' or from
    U+0660 on. Most words fail it and need no regular expression."""
    return (word < ":") | (word >= "\u0660")


def number_tag(tag: Column, prev_lemma: Column, next_lemma: Column,
               lex: Lexicons = DEFAULT_LEXICONS) -> Column:
    """Retag a number from its neighbours (C8). ``tag`` is the current
    word's model tag (quirk Q2: 'previous tag is B-Date' reads the current one)."""
    return (
        F.when(next_lemma.isin(list(lex.months)) | prev_lemma.isin(list(lex.year_prefixes)),
               F.lit(K.TAG_B_DATE))
        .when(prev_lemma.isin(list(lex.months)) | (tag == K.TAG_B_DATE), F.lit(K.TAG_I_DATE))
        .when(next_lemma.isin(list(lex.money)), F.lit(K.TAG_B_MONEY))
        .when(next_lemma.isin(list(lex.percent)), F.lit(K.TAG_B_PERCENT))
        .otherwise(F.lit(K.TAG_OUTSIDE))
    )


def fix_tag(word: Column, lemma: Column, prev_lemma: Column, next_lemma: Column,
            tag: Column, lex: Lexicons = DEFAULT_LEXICONS) -> Column:
    """One word's corrected tag; the first matching rule wins."""
    maybe_number = _maybe_number(word)
    return (
        F.when(word.isin(list(lex.org_words)) & ~tag.isin(list(lex.org_tags)), F.lit(K.TAG_B_ORG))
        .when(maybe_number & is_time(word), F.lit(K.TAG_TIME))
        .when(maybe_number & is_number(word), number_tag(tag, prev_lemma, next_lemma, lex))
        .when(~lemma.isin([*lex.months, *lex.money, *lex.percent]), tag)  # one look for the words of the rules below
        .when(lemma.isin(list(lex.months)),
              F.when(is_digits(prev_lemma), F.lit(K.TAG_I_DATE)).otherwise(F.lit(K.TAG_B_DATE)))
        .when(lemma.isin(list(lex.money)), F.lit(K.TAG_I_MONEY))
        .when(lemma.isin(list(lex.percent)), F.lit(K.TAG_I_PERCENT))
        .otherwise(tag)
    )


def context(tokens: Column, lemmas: Column, i: Column, first_prev_index: int = 2):
    """(previous lemma, lemma, next lemma) for position ``i``.

    The previous lemma is read only from index ``first_prev_index`` on
    (quirk Q1, default 2); missing neighbours are ''. The next lemma exists
    only before the last word."""
    prev = F.when(i >= first_prev_index, F.coalesce(F.get(lemmas, i - 1), F.lit(""))).otherwise(F.lit(""))
    cur = F.coalesce(F.get(lemmas, i), F.lit(""))
    nxt = F.when(i < F.size(tokens) - 1, F.coalesce(F.get(lemmas, i + 1), F.lit(""))).otherwise(F.lit(""))
    return prev, cur, nxt


def fix_tags(tokens: Column | str, lemmas: Column | str, tags: Column | str,
             lex: Lexicons = DEFAULT_LEXICONS, first_prev_index: int = 2) -> Column:
    """Corrected tag array for a sentence (the flagship rule operator)."""
    def body(v: Column) -> Column:
        def one(w: Column, i: Column) -> Column:
            prev, cur, nxt = context(v["w"], v["l"], i, first_prev_index)
            return fix_tag(w, cur, prev, nxt, F.get(v["t"], i), lex)
        return F.transform(v["w"], one)

    return let({"w": _col(tokens), "l": _col(lemmas), "t": _col(tags)}, body)


def neighbour_lemmas(tokens: Column | str, lemmas: Column | str, first_prev_index: int = 2) -> Column:
    """Array of struct(prev_lemma, word, lemma, next_lemma) per word."""
    def body(v: Column) -> Column:
        def one(w: Column, i: Column) -> Column:
            prev, cur, nxt = context(v["w"], v["l"], i, first_prev_index)
            return F.struct(prev.alias("prev_lemma"), w.alias("word"), cur.alias("lemma"),
                            nxt.alias("next_lemma"))
        return F.transform(v["w"], one)

    return let({"w": _col(tokens), "l": _col(lemmas)}, body)
