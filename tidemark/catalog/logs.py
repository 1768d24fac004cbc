"""Log reports and plain counting."""

from pyspark.sql import functions as F

from tidemark.catalog import stand_ins as given
from tidemark.catalog.registry import registered
from tidemark.functions.times import MONTHS
from tidemark.operators.grouping import counted
from tidemark.operators.units import pages_per_key
from tidemark.plans import log_reports
from tidemark.sources.files import inline, table

_LEVEL_MONTH = "SELECT event_type AS level, monthname(ts) AS month, count(*) AS {} FROM events GROUP BY 1, 2"


@registered("level_month_counts", _LEVEL_MONTH.format("count"))
def level_month_counts(spark, folder):
    return log_reports.level_by_month(given.log(spark, folder))


@registered("sql_level_month", _LEVEL_MONTH.format("total"))
def sql_level_month(spark, folder):
    return log_reports.level_by_month_text(given.log(spark, folder))


@registered("sql_grand_total", f"SELECT sum(total)::BIGINT AS total FROM ({_LEVEL_MONTH.format('total')})")
def sql_grand_total(spark, folder):
    return log_reports.total_over_report(log_reports.level_by_month_text(given.log(spark, folder)))


@registered(
    "level_month_pivot",
    "SELECT event_type AS level, "
    + ", ".join(f"count(*) FILTER (WHERE monthname(ts) = '{name}') AS \"{name}\"" for name in MONTHS)
    + " FROM events GROUP BY 1",
)
def level_month_pivot(spark, folder):
    return log_reports.level_month_matrix(given.log(spark, folder))


@registered("count_by_key", "SELECT event_type AS level, count(*) AS count FROM events GROUP BY 1")
def count_by_key(spark, folder):
    """Text lines ``level: time``; the level is the part before the colon."""
    lines = given.log(spark, folder).select(
        F.concat("level", F.lit(": "), F.col("datetime").cast("string")).alias("value")
    )
    return counted(lines, F.split_part("value", F.lit(":"), F.lit(1)).alias("level"))


@registered(
    "collect_per_key",
    """
    SELECT level, page, count(*) AS n,
           string_agg(strftime(ts, '%Y-%m-%d %H:%M:%S'), '|' ORDER BY ts, event_id) AS datetimes
    FROM (SELECT event_type AS level, ts, event_id,
                 (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) // 1000 + 1 AS page
          FROM events)
    GROUP BY level, page
    """,
)
def collect_per_key(spark, folder):
    """All log times of each level, in lists of at most 1000."""
    rows = given.events(spark, folder).withColumn(
        "datetime", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    )
    pages = pages_per_key(rows, "event_type", "ts", "event_id", "datetime", 1000)
    return pages.select(
        F.col("event_type").alias("level"), "page", "n", F.array_join("values", "|").alias("datetimes")
    )


@registered(
    "inline_rows",
    """
    SELECT coalesce(k.kind, 'Missing') AS kind, count(*) AS count, sum(coalesce(k.weight, 0))::BIGINT AS weight
    FROM events e LEFT JOIN (VALUES ('click', 'reading', 1), ('view', 'reading', 2), ('purchase', 'buying', 7))
         k(event_type, kind, weight) ON k.event_type = e.event_type
    GROUP BY 1
    """,
)
def inline_rows(spark, folder):
    """Rows written in the program, looked up for every event."""
    kinds = inline(
        spark, [("click", "reading", 1), ("view", "reading", 2), ("purchase", "buying", 7)],
        "event_type string not null, kind string not null, weight int not null",
    )
    per_type = counted(given.events(spark, folder), "event_type").join(kinds, "event_type", "left")
    weight = F.col("count") * F.coalesce("weight", F.lit(0))
    return per_type.groupBy(F.coalesce("kind", F.lit("Missing")).alias("kind")).agg(
        F.sum("count").alias("count"), F.sum(weight).alias("weight")
    )


@registered(
    "numeric_map_reduce",
    "SELECT sum(p_size)::BIGINT AS total, count(*) AS count, round(sum(sqrt(p_size)), 4) AS roots FROM part",
)
def numeric_map_reduce(spark, folder):
    pairs = table(spark, folder, "part").select(F.col("p_size").alias("value"), F.sqrt("p_size").alias("root"))
    return pairs.agg(
        F.sum("value").alias("total"), F.sum(F.lit(1)).alias("count"), F.round(F.sum("root"), 4).alias("roots")
    )


@registered("value_roots", "SELECT p_partkey, p_size AS value, round(sqrt(p_size), 6) AS root FROM part")
def value_roots(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", F.col("p_size").alias("value"), F.round(F.sqrt("p_size"), 6).alias("root")
    )
