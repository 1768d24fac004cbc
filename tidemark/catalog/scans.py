"""Readers: a table is written out as text by Spark, then scanned."""

from pyspark.sql import functions as F

from tidemark.catalog import stand_ins as given
from tidemark.catalog.registry import registered
from tidemark.session import removed_at_end, shared_folder
from tidemark.plans.reconciliation import accounts_of_messages
from tidemark.sources import files
from tidemark.sources.files import table


def _copied(rows, purpose, form, **options):
    """The rows as files of another format, gone when the application ends."""
    spark = rows.sparkSession
    copy = shared_folder(spark, purpose)
    rows.write.format(form).options(**options).save(copy)
    removed_at_end(spark, copy)
    return copy


@registered("scan_csv_header", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv_header(spark, folder):
    copy = _copied(table(spark, folder, "customer"), "customer-csv", "csv", header=True)
    return files.csv_with_header(
        spark, copy, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    )


@registered(
    "scan_csv_inferred",
    "SELECT c_custkey::INTEGER AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def scan_csv_inferred(spark, folder):
    """Column types found in the file, which is read twice for it."""
    copy = _copied(table(spark, folder, "customer"), "customer-csv", "csv", header=True)
    return files.csv_with_header(spark, copy, infer=True)


@registered("scan_csv_positional", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def scan_csv_positional(spark, folder):
    copy = _copied(table(spark, folder, "supplier"), "supplier-csv", "csv")
    return files.csv_positional(spark, copy, "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")


@registered("scan_text_lines", "SELECT p_partkey || ',' || p_brand || ',' || p_name AS value FROM part")
def scan_text_lines(spark, folder):
    lines = table(spark, folder, "part").select(F.concat_ws(",", "p_partkey", "p_brand", "p_name"))
    copy = _copied(lines, "part-text", "text")
    return files.text_lines(spark, copy)


@registered(
    "json_flatten",
    """
    SELECT user_id AS windowId, event_id AS counter, event_id::VARCHAR AS accountNumber,
           event_type AS accountName, value AS balance, json_extract_string(props, '$.k')::INTEGER AS k
    FROM events
    """,
)
def json_flatten(spark, folder):
    """Nested JSON messages to columns, beside a JSON column of the same row."""
    messages = given.events(spark, folder).select(given.account_json().alias("value"), "props")
    return accounts_of_messages(messages, keep=("props",)).select(
        "windowId", "counter", "account.*", F.from_json("props", "k int").getField("k").alias("k")
    )
