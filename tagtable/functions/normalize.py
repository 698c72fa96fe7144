"""Text normalisation as one Column expression."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtable.constants import NORMALIZATION_RULES, TRIM_PATTERN


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


_META = set("\\^$.|?*+()[]{}")


def _is_literal(pattern: str) -> bool:
    return not any(ch in _META for ch in pattern)


def py_trim(c: Column | str) -> Column:
    """Strip Unicode whitespace at both ends (Spark's ``trim`` only strips spaces)."""
    return F.regexp_replace(_col(c), TRIM_PATTERN, "")


def _apply(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    out = c
    for pattern, replacement in rules:
        if _is_literal(pattern) and "$" not in replacement:
            # A rule without metacharacters is a plain substring replace.
            out = F.replace(out, F.lit(pattern), F.lit(replacement))
        else:
            out = F.regexp_replace(out, pattern, replacement)
    return out


def _bound(c: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a text that is computed once, however often ``body`` reads it."""
    return F.aggregate(F.array(c), F.lit(""), lambda _, v: body(v))


# The fixed rules in forms that cost less and give the same text, where the only decimal digits are 0-9 (texts with others
# take the rules as written). R05 leaves no white space but the plain space, no hyphen and no bracket, and the rules from
# there to R14 do not count spaces, so runs of spaces are made one with it: what is next to a dot can then be told by plain
# substrings. Most of a regular expression's cost is making a string of the text and reading it once, so rules share
# one where they can, and those that cannot are tried only on texts with the characters they need.
_ODD_DIGIT = r"[\x{660}-\x{10ffff}&&[\p{Nd}]]"
_ABOVE_LATIN = r"[\x{1680}-\x{3000}]"  # holds every quote, dash and white space of R05 that is not Latin-1
_LATIN_WS = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"
_SPECIAL = r"""'"`()\[\]/\-|!?;""" + _LATIN_WS
_R01 = ("(?<![a-zA-Z])([a-zA-Z]++):([a-zA-Z]++)", "$1 : $2")
_R04 = (r"([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{4})", "$1 $2 $3")
_R05_LATIN = (f"[{_SPECIAL}]|[.,][ {_LATIN_WS}]*[.,]", " ")
_R06 = (" *: +(?:: +)*", " ")  # leaves one space for several in a row
_R14 = ("  +", " ")
_HIGH = r"[\x{660}-\x{10ffff}]"  # all decimal digits but 0-9 are here, and what the Latin form of R05 does not know
_COLON = ":(?<=[a-zA-Z]:)[a-zA-Z]"  # R01 needs it
_DATE = r"\.[0-9]{1,2}\.[0-9]"  # R04 needs it
_REFERENCE = rf"\[[ {_LATIN_WS}]*+[0-9]++[ {_LATIN_WS}]*+\]"
_R02_R05_R14 = (rf"(?=[ .,{_SPECIAL}])(?: *+(?:(?:{_REFERENCE}|[{_SPECIAL}]|[.,](?:[ {_LATIN_WS}]|{_REFERENCE})*+[.,]) *+)++|  ++)", " ")
_ACCENTS = "áäčďéíĺľňóôŕšťúýžÁÄČĎÉÍĹĽŇÓÔŔŠŤÚÝŽ%"
_ACCENTED = rf"(?=[%\x{{80}}-\x{{ffff}}])([{_ACCENTS}]+[a-zA-Z0-9]*)"
_DOTS = ((r"(?=[ .])(?<=[a-zA-Z]{2}) *\. *", " "), (_ACCENTED + r" *\. *", "$1 "), (r"(?=[ .])(?<=[0-9]) *\. *", " "))  # R07-R09
# The same where single spaces part the words and no dot comes straight after another, so that no rule changes what another finds.
_LONE_DOTS = ((r" ?\.(?<=(?:[a-zA-Z]{2}|[0-9]) ?\.) ?", " "), (_ACCENTED + r" ?\. ?", "$1 "))
_R10_R14 = (  # texts of which it needs one, or none, pattern, replacement
    ([","], ",(?<=[0-9],)([0-9]+,?)", ".$1"), (["%"], "%(?<=[0-9]%) *", " % "), ([], *NORMALIZATION_RULES[11]), ([], *NORMALIZATION_RULES[12]), (["  "], *_R14),
)
_R15_R23 = (
    ([], r" (\+?[0-9]{1,3}) ([0-9]{3}) ([0-9]{2,3})", " $1$2$3"), ([], r" (\+?[0-9]{1,3}) ([0-9]{3}) ", " $1$2 "),
    ([" ."], r" ([a-zA-Záäčďéíĺľňóôŕšťúýž]) \.", " $1."), (["p.", "p ."], r"p *\. *b *\.", "p.b."), ([".c", ".C"], r"\.(?<=[dD]\.)([cC]) *\.", ".$1."),
    (["p.", "p ."], r"o.c.p *\.", "o.c.p."), (["@"], "@(?<=[a-z]@)([a-z]*) +", " @ $1 "), (["&"], "([a-zA-z]) *& *([a-zA-z])", "$1&$2"),
    (["a."], r"a\. *s\.*", "a.s."),
)


def _has(v: Column, *texts: str) -> Column:
    return reduce(Column.__or__, [F.contains(v, F.lit(x)) for x in texts])


def _to_r05(v: Column) -> Column:
    """R01 to R05 and R14 rule by rule."""
    r02, r03, r05 = NORMALIZATION_RULES[1], NORMALIZATION_RULES[2], NORMALIZATION_RULES[4]
    out = _bound(v, lambda v: F.when(_has(v, ":") & v.rlike(_COLON), _apply(v, [_R01])).otherwise(v))
    out = _apply(out, [(r02[0][1:-1], r02[1])])  # its group is not used
    out = _bound(out, lambda v: F.when(_has(v, "-"), _apply(v, [r03])).otherwise(v))
    out = _bound(out, lambda v: F.when(v.rlike(_DATE), _apply(v, [_R04])).otherwise(v))
    out = _bound(out, lambda v: F.when(v.rlike(_ABOVE_LATIN), _apply(v, [r05])).otherwise(_apply(v, [_R05_LATIN])))
    return _apply(out, [_R14])


def _fixed_rules(v: Column) -> Column:
    """The fixed rules over a text, trimmed; null where it has decimal digits but 0-9."""
    rare = _has(v, "-") | v.rlike(_HIGH) | (_has(v, ":") & v.rlike(_COLON)) | v.rlike(_DATE)
    out = F.when(rare, F.when(~v.rlike(_ODD_DIGIT), _to_r05(v))).otherwise(_apply(v, [_R02_R05_R14]))
    out = _bound(out, lambda v: F.when(_has(v, ": "), _apply(v, [_R06])).otherwise(v))
    out = _bound(out, lambda v: F.when(~_has(v, "."), v).when(_has(v, "..", ". ."), _apply(v, _DOTS)).otherwise(_apply(v, _LONE_DOTS)))
    for needs, *rule in _R10_R14 + _R15_R23:
        out = _bound(out, lambda v: F.when(_has(v, *needs), _apply(v, [rule])).otherwise(v)) if needs else _apply(out, [rule])
    return F.trim(_apply(out, NORMALIZATION_RULES[23:]))


def normalize(c: Column | str, rules: Sequence[tuple[str, str]] = NORMALIZATION_RULES,
              trim: bool = True) -> Column:
    """Apply the ordered ``(pattern, replacement)`` rules, each over the whole
    string, then trim. The rules fold into a single nested expression, so the
    whole chain is one projection. The library's own rules run in the cheaper forms above."""
    if rules is not NORMALIZATION_RULES or not trim:
        out = _apply(_col(c), rules)
        return py_trim(out) if trim else out
    return _bound(_col(c), lambda v: F.coalesce(_fixed_rules(v), py_trim(_apply(v, rules))))


def normalize_columns(df: DataFrame, columns: Iterable[str],
                      rules: Sequence[tuple[str, str]] = NORMALIZATION_RULES) -> DataFrame:
    """Normalise the named string columns in place (the caller names them)."""
    return df.withColumns({c: normalize(c, rules) for c in columns})
