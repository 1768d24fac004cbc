"""Exam reports."""

from pyspark.sql import functions as F

from tidemark.catalog import stand_ins as given
from tidemark.catalog.registry import registered
from tidemark.functions.grades import passed
from tidemark.functions.registered import has_passed, register_batched_function
from tidemark.operators.rows import subject_since
from tidemark.plans import exam_reports

_YEARS = range(1995, 2002)
_GRADE = "CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'A+' ELSE 'B' END"


@registered(
    "exam_min_max_avg",
    """
    SELECT o_orderpriority AS subject, max(o_totalprice) AS max_score, min(o_totalprice) AS min_score,
           round(avg(round(o_totalprice, 2)), 2) AS avg_score
    FROM orders GROUP BY 1
    """,
)
def exam_min_max_avg(spark, folder):
    spread = exam_reports.score_spread(given.exam_results(spark, folder))
    return spread.withColumn("avg_score", F.round("avg_score", 2))


@registered(
    "exam_pivot_stats",
    "SELECT o_orderpriority AS subject, "
    + ", ".join(
        f"round({call}(o_totalprice) FILTER (WHERE year(o_orderdate) = {year}), 2) AS \"{year}_{name}\""
        for year in _YEARS for name, call in (("avg", "avg"), ("stddev", "stddev_samp"))
    )
    + " FROM orders GROUP BY 1",
)
def exam_pivot_stats(spark, folder):
    """The years are looked up in the data."""
    return exam_reports.score_matrix(given.exam_results(spark, folder))


@registered(
    "exam_pivot_cell",
    """
    SELECT round(avg(o_totalprice) FILTER (WHERE year(o_orderdate) = 1996), 2) AS "1996_avg",
           o_orderpriority AS subject
    FROM orders WHERE o_orderpriority = '2-HIGH' GROUP BY 2
    """,
)
def exam_pivot_cell(spark, folder):
    return exam_reports.matrix_cell(given.exam_results(spark, folder), "2-HIGH", 1996)


@registered(
    "exam_avg_ratio",
    """
    SELECT o_orderpriority AS subject, round(sum(floor(o_totalprice)) / count(*), 2) AS average
    FROM orders GROUP BY 1
    """,
)
def exam_avg_ratio(spark, folder):
    results = exam_reports.results_of_lines(given.exam_lines(spark, folder))
    return exam_reports.average_ranking(results).withColumn("average", F.round("average", 2))


@registered(
    "sql_avg_ranked",
    "SELECT o_orderpriority AS subject, round(avg(o_totalprice), 2) AS average_score FROM orders GROUP BY 1",
)
def sql_avg_ranked(spark, folder):
    ranking = exam_reports.average_ranking_text(given.exam_results(spark, folder))
    return ranking.withColumn("average_score", F.round("average_score", 2))


@registered(
    "filter_conjunction",
    f"""
    SELECT o_orderkey AS id, o_orderpriority AS subject, year(o_orderdate)::INTEGER AS year,
           o_totalprice AS score, {_GRADE} AS grade
    FROM orders WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) >= 1999
    """,
)
def filter_conjunction(spark, folder):
    results = exam_reports.numeric_scores(given.exam_results(spark, folder))
    return subject_since(results, "1-URGENT", 1999)


@registered(
    "filter_average",
    "SELECT round(avg(o_totalprice), 2) AS average FROM orders WHERE o_orderpriority = '5-LOW'",
)
def filter_average(spark, folder):
    results = exam_reports.numeric_scores(given.exam_results(spark, folder))
    return results.where(F.col("subject") == "5-LOW").agg(F.round(F.avg("score"), 2).alias("average"))


_PASSED = f"""
    SELECT o_orderkey AS id, o_orderpriority AS subject, {_GRADE} AS grade{{extra}},
           CASE WHEN o_orderpriority = '{{strict}}' THEN starts_with({_GRADE}, 'A')
                ELSE starts_with({_GRADE}, 'A+') OR starts_with({_GRADE}, 'B') END AS pass
    FROM orders
"""


@registered("udf_pass_flag", _PASSED.format(extra=f", {_GRADE} = 'A+' AS best", strict="3-MEDIUM"))
def udf_pass_flag(spark, folder):
    rule = passed(F.col("grade"), F.col("subject"), by_subject={"3-MEDIUM": ("A",)})
    results = given.exam_results(spark, folder).select("id", "subject", "grade")
    return results.withColumns({"best": F.col("grade") == "A+", "pass": rule})


@registered("udf_registered_sql", _PASSED.format(extra="", strict="Biology"))
def udf_registered_sql(spark, folder):
    """The same rule as an Arrow-batched Python function called by name from SQL."""
    register_batched_function(spark, "has_passed", has_passed)
    return spark.sql(
        "SELECT id, subject, grade, has_passed(grade, subject) AS pass FROM {results}",
        results=given.exam_results(spark, folder),
    )
