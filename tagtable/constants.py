"""Fixed values that results depend on.

Everything in this module must equal the behaviour being matched: the label
list and its order, the lexicons the tag rules consult, and the ordered
normalisation rules. They are written out plainly, in their natural order.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: label dictionary (id = position in the list).
# The outside label is the digit '0', and 'Time' has no B-/I- prefix.
# ---------------------------------------------------------------------------
LABELS: tuple[str, ...] = (
    "0",
    "B-Person",
    "I-Person",
    "B-Organization",
    "I-Organization",
    "B-Location",
    "I-Location",
    "B-Date",
    "I-Date",
    "Time",
    "B-Money",
    "I-Money",
    "B-Percentage",
    "I-Percentage",
)
NUM_LABELS = len(LABELS)
LABEL_TO_ID = {name: i for i, name in enumerate(LABELS)}

# Named tag ids used by the correction rules.
TAG_OUTSIDE = 0
TAG_B_ORG = 3
TAG_I_ORG = 4
TAG_B_DATE = 7
TAG_I_DATE = 8
TAG_TIME = 9
TAG_B_MONEY = 10
TAG_I_MONEY = 11
TAG_B_PERCENT = 12
TAG_I_PERCENT = 13

# ---------------------------------------------------------------------------
# FIXED VALUES: lexicons consulted by the tag-correction rules.
# ---------------------------------------------------------------------------
MONTH_LEMMAS: tuple[str, ...] = (
    "január",
    "február",
    "marec",
    "apríl",
    "máj",
    "jún",
    "júl",
    "august",
    "september",
    "október",
    "november",
    "december",
)
# The empty string is a member on purpose: a missing previous lemma counts.
YEAR_PREFIX_LEMMAS: tuple[str, ...] = ("", "štvrťrok", "polrok", "rok")
MONEY_LEMMAS: tuple[str, ...] = ("tisíc", "mil", "milión", "miliarda", "euro")
PERCENTAGE_LEMMAS: tuple[str, ...] = ("%", "percento", "p.b")
ORG_FIX_WORDS: tuple[str, ...] = ("NBS", "NAKA")

# ---------------------------------------------------------------------------
# FIXED VALUES: ordered normalisation rules (pattern, replacement).
#
# Spelled portably so Java regex (Spark) and RE2 (DuckDB) agree with the
# original Python semantics: Python's Unicode \s is written as the explicit
# class below and Python's Unicode \d as \p{Nd}. Replacements use $n group
# references (Java); the DuckDB oracle rewrites them to \n.
# ---------------------------------------------------------------------------
WS_CLASS_BODY = r"\t-\r\x1c-\x20\x{85}\p{Z}"
WS = "[" + WS_CLASS_BODY + "]"

_W = WS
_w = WS_CLASS_BODY

NORMALIZATION_RULES: tuple[tuple[str, str], ...] = (
    # R01 space round a colon between letters
    (r"([a-zA-Z]+):([a-zA-Z]+)", "$1 : $2"),
    # R02 drop [12] style references
    (r"(\[" + _W + r"*\p{Nd}+" + _W + r"*\])", " "),
    # R03 numeric ranges
    (r"(\p{Nd})" + _W + r"*-" + _W + r"*(\p{Nd})", "$1 až $2"),
    # R04 d.m.yyyy dates
    (r"(\p{Nd}{1,2})\.(\p{Nd}{1,2})\.(\p{Nd}{4})", "$1 $2 $3"),
    # R05 special characters, whitespace, hyphens, dashes, doubled . and ,
    (
        r"""['"`‘’„“”\(\)\[\]\/(""" + _w + r"""\-|–""" + _w + r"""))!?;…\|]|(\.|,)"""
        + _W + r"""*(\.|,)""",
        " ",
    ),
    # R06 colon before whitespace
    ("(" + _W + "*:" + _W + "+)", " "),
    # R07 dot after a word of two or more letters
    (r"([a-zA-Z]{2,})(" + _W + r"*\." + _W + "*)", "$1 "),
    # R08 dot after an accented letter or %
    (
        r"([áäčďéíĺľňóôŕšťúýžÁÄČĎÉÍĹĽŇÓÔŔŠŤÚÝŽ%]{1,}[a-zA-Z0-9]*)" + _W + r"*(\.)" + _W + "*",
        "$1 ",
    ),
    # R09 dot after a number
    (r"(\p{Nd}{1,})(" + _W + r"*\." + _W + "*)", "$1 "),
    # R10 decimal comma to dot
    (r"([+-]?\p{Nd}+),(\p{Nd}+)", "$1.$2"),
    # R11 split % from its number
    (r"([+-]?\p{Nd}+\.\p{Nd}+|[+-]?\p{Nd})(%)", "$1 $2 "),
    # R12 commas
    (",", " "),
    # R13 euro sign
    ("€", "euro "),
    # R14 collapse whitespace
    (_W + "+", " "),
    # R15, R16 merge grouped numbers
    (r"( [+-]?\p{Nd}{1,3}) (\p{Nd}{3}) (\p{Nd}{2,3})", "$1$2$3"),
    (r"( [+-]?\p{Nd}{1,3}) (\p{Nd}{3}) ([a-z]*)", "$1$2 $3"),
    # R17 single letter followed by ' .'
    ("(" + _W + r"+[a-zA-Záäčďéíĺľňóôŕšťúýž]) \.", "$1."),
    # R18 p. b.
    ("p" + _W + r"*\." + _W + "*b" + _W + r"*\.", "p.b."),
    # R19 d.c .
    (r"(d|D)\.(c|C)" + _W + r"*\.", "$1.$2."),
    # R20 o.c.p . (the dots in o.c.p are wildcards)
    ("o.c.p" + _W + r"*\.", "o.c.p."),
    # R21 split an e-mail address
    ("([a-z])@([a-z]*)" + _W + "+", "$1 @ $2 "),
    # R22, R23 company names
    ("([a-zA-z])" + _W + "*&" + _W + "*([a-zA-z])", "$1&$2"),
    (r"a\." + _W + r"*s[\.]*", "a.s."),
    # R24 a number word
    ("desaťtisíc", "10 tisíc"),
    # R25-R27 repairs of R05
    ("Česko Slovensk", "Československ"),
    ("makro ekonomick", "makroekonomick"),
    ("e mail", "email"),
)

# Trim of Python-style whitespace at both ends.
TRIM_PATTERN = "^" + WS + "+|" + WS + "+$"

# Fixed values that results are compared on: run names and their versions.
# Default value used for runs whose name carries no parent version.
DEFAULT_PARENT_VERSION = "SlovakBERT_NER_Model_V_POC"
PARENT_VERSION_PATTERN = r"(SlovakBERT_NER_Model_V[0-9\.]{5})"

# Version-specific test-row defaults (version -> rows), else the fallback.
VERSION_TEST_ROWS: tuple[tuple[str, int], ...] = (("_POC", 86), ("0.0.1", 7895))
VERSION_TEST_ROWS_DEFAULT = 6254

# Metric groups used when comparing runs.
EVALUATION_COLUMNS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("eval", ("eval/precision", "eval/recall", "eval/f1", "eval/accuracy")),
    ("test", ("test/precision", "test/recall", "test/f1", "test/accuracy")),
    ("macro", ("test/macro_precision", "test/macro_recall", "test/macro_f1")),
)

# Run configurations by version, over the defaults below; the fields that a stage here uses, dropout and batch
# sizes being recorded only. 1.0 and 0.0 stand for yes and no.
RUN_DEFAULTS: tuple[tuple[str, float], ...] = (
    ("num_train_epochs", 3.0), ("learning_rate", 5e-05), ("weight_decay", 0.0), ("per_device_train_batch_size", 8.0),
    ("per_device_eval_batch_size", 8.0), ("hidden_dropout_prob", 0.1), ("attention_probs_dropout_prob", 0.1),
    ("concat_external", 1.0), ("filter_numeric_external", 1.0), ("hyperparameter_tuning", 0.0), ("seed", 42.0),
)
RUN_PRESETS: tuple[tuple[str, tuple[tuple[str, float], ...]], ...] = (
    ("_POC", (("num_train_epochs", 15.0), ("per_device_train_batch_size", 4.0), ("per_device_eval_batch_size", 4.0),
              ("concat_external", 0.0), ("hyperparameter_tuning", 0.0))),
    ("0.0.1", (("num_train_epochs", 15.0), ("per_device_train_batch_size", 8.0), ("per_device_eval_batch_size", 8.0),
               ("concat_external", 1.0), ("filter_numeric_external", 0.0), ("hyperparameter_tuning", 0.0))),
    ("0.0.2", (("num_train_epochs", 15.0), ("per_device_train_batch_size", 8.0), ("per_device_eval_batch_size", 8.0),
               ("concat_external", 1.0), ("filter_numeric_external", 1.0), ("hyperparameter_tuning", 0.0))),
    ("0.0.3", (("num_train_epochs", 15.0), ("per_device_train_batch_size", 4.0), ("per_device_eval_batch_size", 4.0),
               ("concat_external", 1.0), ("filter_numeric_external", 1.0), ("hyperparameter_tuning", 0.0),
               ("early_stopping_patience", 10.0))),
    ("0.0.4", (("num_train_epochs", 15.0), ("per_device_train_batch_size", 4.0), ("per_device_eval_batch_size", 4.0),
               ("concat_external", 1.0), ("filter_numeric_external", 1.0), ("hyperparameter_tuning", 1.0),
               ("early_stopping_patience", 3.0), ("learning_rate", 0.000024981604754), ("weight_decay", 0.285214291922975))),
    ("0.0.5", (("num_train_epochs", 15.0), ("per_device_train_batch_size", 4.0), ("per_device_eval_batch_size", 4.0),
               ("concat_external", 1.0), ("filter_numeric_external", 1.0), ("hyperparameter_tuning", 0.0),
               ("early_stopping_patience", 3.0), ("learning_rate", 0.000024981604754), ("weight_decay", 0.285214291922975),
               ("hidden_dropout_prob", 0.2), ("attention_probs_dropout_prob", 0.25), ("classifier_dropout_value", 0.25))),
    ("0.0.6", (("num_train_epochs", 15.0), ("per_device_train_batch_size", 4.0), ("per_device_eval_batch_size", 4.0),
               ("hyperparameter_tuning", 0.0),
               ("early_stopping_patience", 3.0), ("learning_rate", 0.000024981604754), ("weight_decay", 0.285214291922975),
               ("hidden_dropout_prob", 0.2), ("attention_probs_dropout_prob", 0.25), ("classifier_dropout_value", 0.25))),
)
