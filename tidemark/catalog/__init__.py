"""Named queries over the standard test tables, each with the SQL that must give the same rows."""

from tidemark.catalog import exams, logs, relations, scans, texts, units, viewing  # noqa: F401
from tidemark.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
