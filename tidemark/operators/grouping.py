"""Grouped reports. Everything here aggregates partially before the shuffle, so a key that holds
a large share of the rows reaches the final stage as one row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counted(df: DataFrame, *keys: str | Column, name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def summed(df: DataFrame, value: str, *keys: str | Column, name: str = "total") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def grand_total(df: DataFrame, value: str, name: str = "total") -> DataFrame:
    return df.agg(F.sum(value).alias(name))


def ratio_average(df: DataFrame, value: str, *keys: str, name: str = "average") -> DataFrame:
    """Average as sum over count, both from one pass over the rows; rows without a value count in neither."""
    return df.groupBy(*keys).agg((F.sum(value).cast("double") / F.nullif(F.count(value), F.lit(0))).alias(name))


def spread(df: DataFrame, value: str, *keys: str, digits: int = 2) -> DataFrame:
    """Largest, smallest and average value per key. The value must be a number: text would compare by letters."""
    number = F.col(value)
    return df.groupBy(*keys).agg(
        F.max(number).alias(f"max_{value}"),
        F.min(number).alias(f"min_{value}"),
        F.avg(F.round(number, digits)).alias(f"avg_{value}"),
    )


def pivoted_counts(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Counts as a matrix, 0 where nothing occurs. Naming the columns saves the pass that would look for them."""
    return df.groupBy(row).pivot(column, list(values)).count().na.fill(0)


def pivoted_stats(df: DataFrame, row: str, column: str, value: str, values: Sequence | None = None,
                  digits: int = 2) -> DataFrame:
    """Rounded average and sample standard deviation per cell, columns ``<value>_avg`` and ``<value>_stddev``.

    Without ``values`` Spark first finds the distinct column values (it refuses more than
    ``spark.sql.pivotMaxValues`` of them).
    """
    groups = df.groupBy(row)
    groups = groups.pivot(column) if values is None else groups.pivot(column, list(values))
    return groups.agg(
        F.round(F.avg(value), digits).alias("avg"),
        F.round(F.stddev_samp(value), digits).alias("stddev"),
    )
