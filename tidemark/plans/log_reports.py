"""Log levels by month. A log has the columns ``level`` and ``datetime`` (a timestamp)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.registered import register_sql_functions
from tidemark.functions.times import MONTHS, month_name, month_number
from tidemark.operators.grouping import counted, pivoted_counts


def level_by_month(log: DataFrame) -> DataFrame:
    """``level, month, count`` in calendar order. All years of a month count together.

    Grouping is by the month's number; its name is put in afterwards, on the few result rows.
    """
    per_month = counted(log, "level", month_number(F.col("datetime")).alias("monthnum"))
    return per_month.orderBy("monthnum", "level").select(
        "level", month_name(F.col("monthnum")).alias("month"), "count"
    )


def level_month_matrix(log: DataFrame, months: Sequence[str] = MONTHS) -> DataFrame:
    """One row per level, one column per listed name; a name that is no month gives a column of zeros."""
    named = log.select("level", month_name(month_number(F.col("datetime"))).alias("month"))
    return pivoted_counts(named, "level", "month", months)


def level_by_month_text(log: DataFrame) -> DataFrame:
    """The same report as SQL text: ``level, month, total``."""
    spark = log.sparkSession
    register_sql_functions(spark)
    months = ", ".join(f"'{name}'" for name in MONTHS)
    return spark.sql(
        f"""
        SELECT level, month, total
        FROM (SELECT level, month, month_num(month) AS place, total
              FROM (SELECT level, element_at(array({months}), month(datetime)) AS month, count(1) AS total
                    FROM {{log}} GROUP BY ALL))
        ORDER BY place, level
        """,
        log=log,
    )


def total_over_report(report: DataFrame, column: str = "total") -> DataFrame:
    """Sum of a column of a finished report, as SQL text."""
    return report.sparkSession.sql(f"SELECT sum({column}) AS total FROM {{report}}", report=report)


