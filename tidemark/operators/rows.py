"""Filters, unions, distinct rows and rankings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def subject_since(df: DataFrame, subject: str, year: int) -> DataFrame:
    """Rows of one subject from a year on; the year may still be text."""
    return df.where((F.col("subject") == subject) & (F.col("year").try_cast("int") >= year))


def without_listed(df: DataFrame, column: str, listed: Sequence[str] | DataFrame) -> DataFrame:
    """Rows whose value is not in a list. A list kept as a table (one column) becomes an anti join."""
    if isinstance(listed, DataFrame):
        return df.join(listed.toDF(column).distinct(), column, "left_anti")
    return df.where(~F.col(column).isin(list(listed)))


def stacked(*parts: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept, columns matched by name."""
    return reduce(DataFrame.unionByName, parts)


def distinct_of(*parts: DataFrame) -> DataFrame:
    return stacked(*parts).dropDuplicates()


def top(df: DataFrame, k: int, by: str | Column, *ties: str | Column) -> DataFrame:
    """The ``k`` rows with the largest ``by``. Ties are settled by further columns, so the result is one and the same.

    Each task keeps its own ``k`` best rows before anything moves.
    """
    return df.orderBy(F.desc(by) if isinstance(by, str) else by.desc(), *ties).limit(k)


def ranked(df: DataFrame, by: str, *ties: str | Column, ascending: bool = False) -> DataFrame:
    """All rows in order, over range partitions."""
    return df.orderBy(F.asc(by) if ascending else F.desc(by), *ties)
