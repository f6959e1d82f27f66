"""Text columns: cleaning, normalising, tokens, measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
LINE_BREAK_TAG = r"(?i)<br[ \t\r\n]*/?>"
SPACES = r"[ \t]+"
WHITESPACE = r"[ \t\r\n\x0B\x0C]+"
NOT_WORD = r"[^\p{L}\p{N}]+"
NOT_LETTER = r"[^\p{L}]+"

# Typographic characters and their plain forms, position by position.
TYPOGRAPHIC = "\u2018\u2019\u201a\u201c\u201d\u201e\u00ab\u00bb\u2013\u2014\u2212\u00a0"
PLAIN = "'''\"\"\"\"\"--- "


def clean(text: Column) -> Column:
    """Control characters and ``<br>`` tags out, runs of blanks to one, ends trimmed."""
    text = F.regexp_replace(text, LINE_BREAK_TAG, " ")
    text = F.regexp_replace(text, CONTROL, "")
    return F.trim(F.regexp_replace(text, SPACES, " "))


def normalise(text: Column) -> Column:
    """Lower case, plain punctuation, all white space to single blanks."""
    plain = F.translate(F.lower(text), TYPOGRAPHIC, PLAIN)
    return F.trim(F.regexp_replace(plain, WHITESPACE, " "))


def tokens(text: Column) -> Column:
    """Runs of letters and digits."""
    return F.filter(F.split(text, NOT_WORD), lambda token: token != "")


def token_count(text: Column) -> Column:
    return F.size(tokens(text)).cast("long")


def line_count(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")


def letter_ratio(text: Column) -> Column:
    """Share of letters among all characters; 0 for empty text."""
    letters = F.length(F.regexp_replace(text, NOT_LETTER, ""))
    return F.when(F.length(text) == 0, F.lit(0.0)).otherwise(letters / F.length(text))
