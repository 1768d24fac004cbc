"""Functions callable by name from SQL text and from ``F.call_function``."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tidemark.functions.grades import PASS_BY_SUBJECT, PASS_OTHERWISE
from tidemark.functions.times import MONTHS


def _quoted(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


# SQL functions are expanded into the calling plan, so they stay inside generated JVM code.
SQL_FUNCTIONS = {
    "month_num": (
        "name STRING", "INT",
        f"CAST(nullif(array_position(array({_quoted(MONTHS)}), name), 0) AS INT)",
    ),
    "is_even": ("value BIGINT", "BOOLEAN", "value % 2 = 0"),
    "first_mention": (
        "text STRING", "STRING",
        "coalesce(nullif(regexp_extract(text, '(?:^| )(@[^ ]*)', 1), ''), 'No tag')",
    ),
}


def register_sql_functions(spark: SparkSession) -> None:
    for name, (arguments, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")


@F.pandas_udf(BooleanType())
def has_passed(grade: pd.Series, subject: pd.Series) -> pd.Series:
    """The pass rule as an Arrow-batched user function, for callers who bring their own Python rules."""
    result = grade.str.startswith(tuple(PASS_OTHERWISE))
    for name, prefixes in PASS_BY_SUBJECT.items():
        result = result.where(subject != name, grade.str.startswith(tuple(prefixes)))
    return result


def register_batched_function(spark: SparkSession, name: str, function) -> None:
    """Register a ``pandas_udf`` under a SQL name."""
    spark.udf.register(name, function)
