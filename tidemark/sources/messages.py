"""Typed rows out of message payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

POST_SCHEMA = "created_at string, id bigint, id_str string, text string"
ACCOUNT_SCHEMA = (
    "windowId bigint, counter bigint, "
    "account struct<accountNumber: string, accountName: string, balance: double>"
)


def json_columns(messages: DataFrame, schema: StructType | str, column: str = "value",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns of a JSON payload (binary or text); a payload that is no JSON object gives nulls.

    ``inline`` keeps the parsed payload apart from later filters: otherwise the optimizer would copy the parsing
    into every filter on one of its fields and parse each message more than once.
    """
    payload = F.from_json(F.col(column).cast("string"), schema)
    return messages.select(*keep, F.inline(F.array(payload)))


def csv_columns(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Columns of a delimited line, by position and typed; an unreadable field gives null."""
    return lines.select(F.from_csv(F.col(column), schema).alias("fields")).select("fields.*")
