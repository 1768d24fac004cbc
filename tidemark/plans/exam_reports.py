"""Exam results by subject and year. Results have the columns ``subject, year, score, grade``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.grouping import pivoted_stats, ratio_average, spread
from tidemark.operators.rows import ranked
from tidemark.sources.messages import csv_columns

# Fields of one result line by position; two of them are not used.
RESULT_LINE = "id int, unused_1 string, subject string, year int, unused_4 string, score int, grade string"


def results_of_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    return csv_columns(lines, RESULT_LINE, column).select("id", "subject", "year", "score", "grade")


def numeric_scores(results: DataFrame) -> DataFrame:
    """Scores that arrive as text, as numbers; text that is no number becomes null instead of failing the job."""
    return results.withColumn("score", F.col("score").try_cast("double"))


def score_spread(results: DataFrame) -> DataFrame:
    """``subject, max_score, min_score, avg_score``."""
    return spread(numeric_scores(results), "score", "subject")


def score_matrix(results: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """``subject, <year>_avg, <year>_stddev, …``; the years are looked up when not given."""
    return pivoted_stats(numeric_scores(results), "subject", "year", "score", years)


def matrix_cell(results: DataFrame, subject: str, year: int) -> DataFrame:
    """The average of one subject and year, read from the matrix: ``<year>_avg, subject``."""
    return score_matrix(results, [year]).where(F.col("subject") == subject).select(f"{year}_avg", "subject")


def average_ranking(results: DataFrame) -> DataFrame:
    """``subject, average``, best first."""
    return ranked(ratio_average(results, "score", "subject"), "average", "subject")


def average_ranking_text(results: DataFrame) -> DataFrame:
    """``subject, average_score``, best first, as SQL text."""
    return results.sparkSession.sql(
        """
        SELECT subject, avg(try_cast(score AS double)) AS average_score
        FROM {results} GROUP BY subject ORDER BY average_score DESC, subject
        """,
        results=results,
    )
