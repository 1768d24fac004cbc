"""Joins, unions, distinct rows and course scores."""

from pyspark.sql import functions as F

from tidemark.catalog.registry import registered
from tidemark.operators import joins
from tidemark.operators.grouping import counted
from tidemark.operators.rows import distinct_of, stacked
from tidemark.plans.course_scores import course_scores as scored
from tidemark.sources.files import table


def _visits(spark, folder):
    """Lines per order, counted before the join."""
    return counted(table(spark, folder, "lineitem"), F.col("l_orderkey").alias("order_id"), name="visits")


def _users(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("name")
    )


_VISITS = "(SELECT l_orderkey AS order_id, count(*) AS visits FROM lineitem GROUP BY 1) v"


@registered(
    "join_inner",
    f"SELECT v.order_id, v.visits, o.o_orderpriority AS name FROM {_VISITS} JOIN orders o ON o.o_orderkey = v.order_id",
)
def join_inner(spark, folder):
    return joins.matched(_visits(spark, folder), _users(spark, folder), "order_id")


@registered(
    "join_left_default",
    f"""
    SELECT o.o_orderkey AS order_id, o.o_orderpriority AS name,
           upper(coalesce('seen ' || v.visits, 'Missing')) AS seen
    FROM orders o LEFT JOIN {_VISITS} ON v.order_id = o.o_orderkey
    """,
)
def join_left_default(spark, folder):
    seen = _visits(spark, folder).select(
        "order_id", F.concat(F.lit("seen "), F.col("visits").cast("string")).alias("seen")
    )
    joined = joins.left_with_default(_users(spark, folder), seen, "order_id", "seen", "Missing")
    return joined.withColumn("seen", F.upper("seen"))


@registered(
    "join_right_default",
    f"""
    SELECT o.o_orderkey AS order_id, coalesce(v.visits, 0) AS visits,
           'User ' || o.o_orderpriority || ' had ' || coalesce(v.visits, 0) || ' visits.' AS sentence
    FROM orders o LEFT JOIN {_VISITS} ON o.o_orderkey = v.order_id
    """,
)
def join_right_default(spark, folder):
    joined = joins.right_with_default(_visits(spark, folder), _users(spark, folder), "order_id", "visits", 0)
    sentence = joins.visit_sentence(F.col("name"), F.col("visits"))
    return joined.select("order_id", "visits", sentence.alias("sentence"))


@registered("join_cross", "SELECT c_custkey, c_name, r_regionkey, r_name FROM customer, region")
def join_cross(spark, folder):
    """Every customer with every region; the number of regions is fixed."""
    return joins.every_pair(
        table(spark, folder, "customer").select("c_custkey", "c_name"),
        table(spark, folder, "region").select("r_regionkey", "r_name"),
    )


def _view_parts(spark, folder):
    """Three inputs of one shape: who (supplier, customer, part) touched which order."""
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    return (
        lines.select(F.col("l_suppkey").alias("user_id"), F.col("l_orderkey").alias("order_id")),
        orders.select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("order_id")),
        lines.select(F.col("l_partkey").alias("user_id"), F.col("l_orderkey").alias("order_id")),
    )


_UNION = (
    "SELECT l_suppkey AS user_id, l_orderkey AS order_id FROM lineitem "
    "UNION {0} SELECT o_custkey, o_orderkey FROM orders UNION {0} SELECT l_partkey, l_orderkey FROM lineitem"
)


@registered("union_all", _UNION.format("ALL"))
def union_all(spark, folder):
    return stacked(*_view_parts(spark, folder))


@registered("distinct_pairs", _UNION.format(""))
def distinct_pairs(spark, folder):
    return distinct_of(*_view_parts(spark, folder))


@registered("sql_distinct", "SELECT DISTINCT year(o_orderdate)::INTEGER AS year FROM orders")
def sql_distinct(spark, folder):
    return spark.sql("SELECT DISTINCT year(o_orderdate) AS year FROM {orders}", orders=table(spark, folder, "orders"))


@registered(
    "course_scores",
    """
    WITH chapters AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem),
         sizes AS (SELECT l_orderkey, count(*) AS chapters FROM chapters GROUP BY 1),
         seen AS (SELECT l_suppkey, l_orderkey, count(*) AS seen
                  FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber FROM lineitem) GROUP BY 1, 2),
         points AS (SELECT l_orderkey, CASE WHEN seen / chapters::DOUBLE >= 0.9 THEN 10
                                            WHEN seen / chapters::DOUBLE >= 0.5 THEN 4
                                            WHEN seen / chapters::DOUBLE >= 0.25 THEN 2 ELSE 0 END AS points
                    FROM seen JOIN sizes USING (l_orderkey))
    SELECT sum(points)::BIGINT AS score, o_orderpriority || ' ' || o_orderkey AS title
    FROM points JOIN orders ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderpriority
    """,
)
def course_scores(spark, folder):
    """A course is an order, its chapters the order's line numbers, its viewers the suppliers of those lines."""
    lines = table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("chapter_id"),  # line numbers are 1 to 7
        F.col("l_orderkey").alias("course_id"), F.col("l_suppkey").alias("user_id"),
    )
    # Saying that chapters have no nulls makes both uses of them the same plan, so they are shuffled once.
    known = F.col("chapter_id").isNotNull() & F.col("course_id").isNotNull()
    chapters = lines.select("chapter_id", "course_id").where(known).dropDuplicates()
    titles = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("course_id"), F.concat_ws(" ", "o_orderpriority", "o_orderkey").alias("title")
    )
    return scored(chapters, [lines], titles)
