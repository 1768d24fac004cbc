"""Compare a query with its SQL on DuckDB."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, folder, query, sql):
    """Both results as sorted rows, column names first."""
    found = query(spark, folder)
    expected = duck(folder).sql(sql)
    ours = (sorted(found.columns), sorted_rows(found.columns, found.collect()))
    theirs = (sorted(expected.columns), sorted_rows(expected.columns, expected.fetchall()))
    return ours, theirs
