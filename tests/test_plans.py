"""What Spark makes of the queries: pruned scans, pushed filters, combine before shuffle, no row-wise Python."""

import re

import pytest

from tidemark.catalog import QUERIES

PYTHON = {"udf_registered_sql", "units_idle", "units_deadline", "units_exact_members", "collect_per_key"}
ALL_PAIRS = {"join_cross"}
BATCH = sorted(name for name in QUERIES if not name.startswith("stream_"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(spark, df):
    execution = df._jdf.queryExecution()
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return execution.explainString(mode)


@pytest.mark.parametrize("name", BATCH)
def test_python_and_pairing_stay_where_they_belong(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert bool(re.search("ArrowEvalPython|MapInArrow|FlatMapGroupsInPandas", text)) == (name in PYTHON)
    assert "BatchEvalPython" not in text
    assert bool(re.search("CartesianProduct|NestedLoopJoin", text)) == (name in ALL_PAIRS)
    windows = re.findall(r"Window \[[^\n]*", text)
    assert not windows or name == "units_once"


def test_scan_reads_only_two_columns(spark, sf_dir):
    text = formatted(spark, QUERIES["level_month_counts"](spark, sf_dir))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text
    assert "partial_count" in text


def test_filter_reaches_the_scan(spark, sf_dir):
    text = formatted(spark, QUERIES["filter_conjunction"](spark, sf_dir))
    assert "EqualTo(o_orderpriority,1-URGENT)" in text


def test_top_k_keeps_k_rows_per_task(spark, sf_dir):
    for name in ("word_ranking", "mention_top20"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_messages_are_parsed_once(spark, sf_dir):
    text = plan(QUERIES["mention_top20"](spark, sf_dir))
    assert len(re.findall(r"from_json\(", text)) == 1


def test_sliding_windows_copy_pane_totals_not_rows(spark, sf_dir):
    text = plan(QUERIES["window_sliding"](spark, sf_dir))
    expand = text.index("Expand")
    assert "HashAggregate" in text[expand:], "rows are added up per pane below the expansion"


def test_spans_of_time_are_cut_from_the_times_alone(spark, sf_dir):
    from tidemark.streaming.replay import by_time, spans_of_time

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    written = spark.read.parquet(by_time(events, "ts", 4000, 4))
    assert written.select("slice").distinct().count() == 4 and written.count() == events.count()
    span, last = spans_of_time(events, "ts", 4000, 4)
    assert last == 3 and "Exchange" not in plan(events.select(span.alias("slice")))


def test_a_query_leaves_the_time_zone_of_its_caller(spark, sf_dir):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        found = [sorted(map(tuple, QUERIES[name](spark, sf_dir).collect()), key=str) for name in ("window_tumbling", "parse_post_time", "level_month_counts")]
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == [sorted(map(tuple, QUERIES[name](spark, sf_dir).collect()), key=str) for name in ("window_tumbling", "parse_post_time", "level_month_counts")]
