"""Joins with defaults. No side is broadcast by hint: Spark broadcasts a side only when its measured size
is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, with skew splitting by AQE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right, key, "inner")


def left_with_default(left: DataFrame, right: DataFrame, key: str, column: str, default) -> DataFrame:
    """All left rows; ``column`` of the right side is ``default`` where nothing matches."""
    return left.join(right, key, "left").withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def right_with_default(left: DataFrame, right: DataFrame, key: str, column: str, default) -> DataFrame:
    """All right rows; ``column`` of the left side is ``default`` where nothing matches."""
    return left.join(right, key, "right").withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def visit_sentence(name: Column, visits: Column) -> Column:
    return F.concat(F.lit("User "), name, F.lit(" had "), visits.cast("string"), F.lit(" visits."))


def every_pair(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every left row with every right row.

    The result has ``|left| * |right|`` rows by definition. Spark broadcasts a side whose measured bytes are below
    its threshold and otherwise pairs partition by partition.
    """
    return left.crossJoin(right)
