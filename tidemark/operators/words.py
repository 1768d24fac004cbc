"""Word and mention counting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import texts
from tidemark.operators.grouping import counted
from tidemark.operators.rows import without_listed


def letter_words(df: DataFrame, text: str = "value") -> DataFrame:
    """One row per word made of letters only, as written."""
    return df.select(F.explode(texts.words_of_lines(F.col(text))).alias("word")).where(
        texts.only_letters(F.col("word"))
    )


def keyword_counts(df: DataFrame, text: str = "value", stop_words=texts.STOP_WORDS) -> DataFrame:
    """Lower-cased words with their counts, without the stop words (a list, or a one-column table).

    Stop words are taken out of the counts: a list is a filter, which Spark moves in front of the counting, and a
    table too large to broadcast is joined with one row per word instead of one per occurrence.
    """
    words = letter_words(df, text).select(F.lower("word").alias("word"))
    return without_listed(counted(words, "word"), "word", stop_words)


def title_word_counts(df: DataFrame, title: str = "title") -> DataFrame:
    titles = df.where(texts.not_blank(F.col(title)))
    return counted(titles.select(F.explode(texts.title_words(F.col(title))).alias("word")), "word")


def mentions(posts: DataFrame, text: str = "text", prefix: str = "@") -> DataFrame:
    """Posts with the first mention in them; posts without one are left out.

    Exploding the mention, if any, finds it once per post; a null filter would look for it twice.
    """
    found = F.array_compact(F.array(texts.first_token(F.col(text), prefix)))
    return posts.select("*", F.explode(found).alias("mention"))
