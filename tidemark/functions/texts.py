"""Word, title and mention expressions. All are built-in expressions: no Python runs per row."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that say nothing about what a text is about.
STOP_WORDS = (
    "to", "from", "it", "there", "tidy", "a", "and", "the", "of", "we", "this", "is", "i", "on",
    "for", "be", "do", "you", "in", "so", "if", "but", "can", "that", "have", "going",
)

# The ASCII punctuation marks.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

_CONTROL_AND_BLANK = "".join(map(chr, range(33)))


def words_of_lines(text: Column) -> Column:
    """Blank-separated parts of every line. Line ends separate words as blanks do."""
    return F.split(text, "[ \n\r]")


def only_letters(word: Column) -> Column:
    """True where the whole word is ASCII letters (a trailing line end does not pass)."""
    return word.rlike(r"\A[a-zA-Z]+\z")


def not_blank(text: Column) -> Column:
    return text.rlike(r"\P{javaWhitespace}")


def without_punctuation(text: Column) -> Column:
    return F.translate(text, PUNCTUATION, "")


def field_or_empty(line: Column, position: int, delimiter: str = ",") -> Column:
    """The field at a zero-based position of an unquoted line, ``""`` where the line is too short."""
    return F.coalesce(F.get(F.split(line, re.escape(delimiter)), F.lit(position)), F.lit(""))


def title_words(title: Column) -> Column:
    """Lower-cased words of a title without punctuation.

    Blanks at the end make no words, blanks at the start or doubled ones make empty words,
    and a title of nothing but punctuation is one empty word.
    """
    bare = without_punctuation(F.trim(F.lower(title), F.lit(_CONTROL_AND_BLANK)))
    return F.when((bare != "") & (F.rtrim(bare) == ""), F.array().cast("array<string>")).otherwise(
        F.split(F.rtrim(bare), " ")
    )


def first_token(text: Column, prefix: str = "@") -> Column:
    """First blank-separated token that starts with ``prefix``; null where there is none or no text."""
    found = F.regexp_extract(text, f"(?:^| )({re.escape(prefix)}[^ ]*)", 1)
    return F.when(found != "", found)
