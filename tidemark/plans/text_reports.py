"""Keyword ranking of texts and word counts of titles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.texts import STOP_WORDS, field_or_empty
from tidemark.operators.rows import ranked, top
from tidemark.operators.words import keyword_counts, title_word_counts


def top_keywords(texts: DataFrame, column: str = "value", k: int = 100, stop_words=STOP_WORDS) -> DataFrame:
    """``count, word`` of the ``k`` most frequent words."""
    return top(keyword_counts(texts, column, stop_words), k, "count", "word").select("count", "word")


def title_word_report(lines: DataFrame, column: str = "value", position: int = 2) -> DataFrame:
    """``word, count`` over the titles of comma-separated lines, rarest first."""
    titles = lines.select(field_or_empty(F.col(column), position).alias("title"))
    return ranked(title_word_counts(titles), "count", "word", ascending=True)
