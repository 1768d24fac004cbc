"""Batch readers. Every text format takes an explicit schema; inference is an option because it reads twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table. Parquet carries its own schema."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_columns(*names: str) -> StructType:
    """Schema of nullable text columns: how an untyped CSV arrives."""
    return StructType([StructField(name, StringType(), True) for name in names])


def csv_with_header(spark: SparkSession, path: str, schema: StructType | str | None = None,
                    infer: bool = False) -> DataFrame:
    """CSV whose files start with a header line, which is dropped from every file."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def csv_positional(spark: SparkSession, paths: str | list[str], schema: StructType | str) -> DataFrame:
    """CSV without header; columns are named by position. Several paths are read as one input."""
    return spark.read.schema(schema).csv(paths)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def inline(spark: SparkSession, rows: list[tuple], schema: StructType | str) -> DataFrame:
    """Rows written in the program, with an explicit schema."""
    return spark.createDataFrame(rows, schema)
