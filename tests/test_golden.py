"""Small inputs with results worked out by hand."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import grades, registered, texts, times
from tidemark.operators import grouping, joins, rows, words
from tidemark.operators.grouping import counted, grand_total, pivoted_counts, summed
from tidemark.plans import exam_reports, log_reports, mentions, text_reports, viewing
from tidemark.plans.course_scores import course_scores
from tidemark.session import settings
from tidemark.sources import files, messages

# Sample log rows, log lines, visits and users.
LOG = [
    ("WARN", "2016-12-31 04:19:32"), ("FATAL", "2016-12-31 03:22:34"), ("WARN", "2016-12-31 03:21:21"),
    ("INFO", "2015-4-21 14:32:21"), ("FATAL", "2015-4-21 19:23:20"),
]
LINES = [
    ("WARN: Tuesday 4 September 0405",), ("ERROR: Tuesday 4 September 0408",),
    ("FATAL: Wednesday 5 September 1632",), ("ERROR: Friday 7 September 1854",),
    ("WARN: Saturday 8 September 1942",),
]
VISITS = [(4, 18), (6, 4), (10, 9)]
USERS = [(1, "John"), (2, "Bob"), (3, "Alan"), (4, "Doris"), (5, "Marybelle"), (6, "Raquel")]


def got(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def log(spark):
    rows_ = files.inline(spark, LOG, "level string not null, datetime string not null")
    return rows_.withColumn("datetime", times.log_time(F.col("datetime")))


@pytest.fixture(scope="module")
def visits(spark):
    return files.inline(spark, VISITS, "user_id int, visits int")


@pytest.fixture(scope="module")
def users(spark):
    return files.inline(spark, USERS, "user_id int, name string")


def test_log_report(log):
    expected = [("FATAL", "April", 1), ("INFO", "April", 1), ("FATAL", "December", 1), ("WARN", "December", 2)]
    assert got(log_reports.level_by_month(log)) == expected
    assert got(log_reports.level_by_month_text(log)) == expected
    assert got(log_reports.total_over_report(log_reports.level_by_month_text(log))) == [(5,)]


def test_unknown_pivot_name_gives_zeros(log):
    found = log_reports.level_month_matrix(log, ["April", "AugSeptember", "December"])
    assert sorted(got(found)) == [("FATAL", 1, 0, 1), ("INFO", 1, 0, 0), ("WARN", 0, 0, 2)]


def test_counts_and_sums(spark, visits):
    lines = files.inline(spark, LINES, "value string")
    per_level = counted(lines, F.split_part("value", F.lit(":"), F.lit(1)).alias("level"))
    assert sorted(got(per_level)) == [("ERROR", 2), ("FATAL", 1), ("WARN", 2)]
    assert got(grand_total(visits, "visits")) == [(31,)]
    assert sorted(got(summed(visits, "visits", "user_id"))) == [(4, 18), (6, 4), (10, 9)]
    assert "Tuesday" in [w for w, in got(words.letter_words(lines))] and "4" not in [
        w for w, in got(words.letter_words(lines))
    ]


def test_joins(visits, users):
    assert sorted(got(joins.matched(visits, users, "user_id"))) == [(4, 18, "Doris"), (6, 4, "Raquel")]
    left = joins.left_with_default(visits, users, "user_id", "name", "Missing")
    assert sorted(r.name.upper() for r in left.collect()) == ["DORIS", "MISSING", "RAQUEL"]
    right = joins.right_with_default(visits, users, "user_id", "visits", 0)
    said = right.select(joins.visit_sentence(F.col("name"), F.col("visits")))
    assert "User Bob had 0 visits." in [r[0] for r in said.collect()] and said.count() == 6
    assert joins.every_pair(visits, users).count() == 18


def test_every_pair_broadcasts_only_below_the_measured_threshold(spark, visits, users):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        pairs = joins.every_pair(visits, users)
        assert "CartesianProduct" in pairs._jdf.queryExecution().executedPlan().toString() and pairs.count() == 18


def test_ratio_average_counts_only_rows_with_a_value(spark):
    rows = spark.createDataFrame([("a", 10), ("a", None), ("b", None)], "k string, v int")
    assert sorted(map(tuple, grouping.ratio_average(rows, "v", "k").collect())) == [("a", 10.0), ("b", None)]


def test_account_ids_beyond_the_int_range(spark):
    rows = spark.createDataFrame([('{"windowId": 3000000000, "counter": 3000000001}',)], "value string")
    found = messages.json_columns(rows, messages.ACCOUNT_SCHEMA).first()
    assert (found.windowId, found.counter) == (3_000_000_000, 3_000_000_001)


def test_log_lines_of_both_layouts_and_short_ones(spark):
    rows = spark.createDataFrame([("WARN,2024-01-02 10:11:12",), ("INFO,Tue Jan 02 10:11:12 GMT 2024",), ("FATAL",), ("",)], "value string")
    found = [(r.level, str(r.ts)) for r in viewing.levels_of_lines(rows).select("level", F.col("ts").cast("string").alias("ts")).collect()]
    assert found == [("WARN", "2024-01-02 10:11:12"), ("INFO", "2024-01-02 10:11:12"), ("FATAL", "None"), ("", "None")]


def test_exam_reports(spark):
    lines = files.inline(spark, [
        ("1,x,Math,2005,x,9,A+",), ("2,x,Math,2005,x,100,B",), ("3,x,Art,2006,x,50,A",), ("4,x,Art,2007,x,bad,C",),
    ], "value string")
    results = exam_reports.results_of_lines(lines)
    # 9 and 100 compare as numbers; a score that is no number counts for nothing
    assert sorted(got(exam_reports.score_spread(results))) == [("Art", 50.0, 50.0, 50.0), ("Math", 100.0, 9.0, 54.5)]
    matrix = exam_reports.score_matrix(results)
    assert matrix.columns == ["subject", *(f"{y}_{name}" for y in (2005, 2006, 2007) for name in ("avg", "stddev"))]
    assert got(exam_reports.matrix_cell(results, "Math", 2005)) == [(54.5, "Math")]
    assert got(rows.subject_since(results, "Art", 2007).select("id")) == [(4,)]
    assert [r.subject for r in exam_reports.average_ranking_text(results).collect()] == ["Math", "Art"]


def test_pass_rule(spark):
    marks = [("A", "Biology"), ("A", "Math"), ("A+", "Math"), ("B", "Math"), ("B", "Biology"), ("C", "Math")]
    df = files.inline(spark, marks, "grade string, subject string")
    expected = [True, False, True, True, False, False]
    assert [r[0] for r in df.select(grades.passed(F.col("grade"), F.col("subject"))).collect()] == expected
    registered.register_batched_function(spark, "has_passed", registered.has_passed)
    assert [r[0] for r in df.selectExpr("has_passed(grade, subject)").collect()] == expected


def test_named_functions(spark):
    registered.register_sql_functions(spark)
    row = spark.sql(
        "SELECT month_num('March'), month_num('AugSeptember'), is_even(4L), "
        "first_mention('x @a @b'), first_mention('a@b')"
    ).first()
    assert tuple(row) == (3, None, True, "@a", "No tag")
    df = spark.range(2).select(F.call_function("is_even", "id"))
    assert sorted(r[0] for r in df.collect()) == [False, True]


def test_bands_are_inclusive(spark):
    shares = files.inline(spark, [(0.9,), (0.89,), (0.5,), (0.25,), (0.24,)], "share double")
    assert [r[0] for r in shares.select(grades.banded(F.col("share"))).collect()] == [10, 4, 4, 2, 0]


def test_course_scores(spark):
    chapters = files.inline(spark, [(c, 1) for c in range(10)] + [(20, 2), (21, 2)], "chapter_id int, course_id int")
    first = files.inline(spark, [(7, c) for c in range(9)] + [(7, 0), (8, 0)], "user_id int, chapter_id int")
    second = files.inline(spark, [(7, 1), (8, 20), (9, 99)], "user_id int, chapter_id int")
    titles = files.inline(spark, [(1, "Ten"), (2, "Two"), (3, "None")], "course_id int, title string")
    assert got(course_scores(chapters, [first, second], titles)) == [(10, "Ten"), (4, "Two")]


def test_title_words(spark):
    lines = [
        "1,c,  Hello, World", "2,c", "3,c,   ", "4,c,!?", "5,c,- -", "6,c,\tA  (b) -", "7,c,hello",
    ]
    df = files.inline(spark, [(x,) for x in lines], "value string")
    assert got(text_reports.title_word_report(df)) == [("a", 1), ("b", 1), ("", 2), ("hello", 2)]


def test_keywords(spark):
    df = files.inline(spark, [("The cat\nsat on the Cat's mat\r\ncat 2nd",), ("Going cat sat",)], "value string")
    assert got(text_reports.top_keywords(df, k=2)) == [(3, "cat"), (2, "sat")]
    listed = files.inline(spark, [("cat",)], "w string")
    assert "cat" not in [w for _, w in got(text_reports.top_keywords(df, stop_words=listed))]


def test_only_letters_takes_the_whole_word(spark):
    df = files.inline(spark, [("abc",), ("abc\n",), ("",), ("aé",)], "w string")
    assert [r[0] for r in df.select(texts.only_letters(F.col("w"))).collect()] == [True, False, False, False]


def test_mentions(spark):
    posts = files.inline(
        spark, [("hi @a and @b",), ("@c",), ("mail x@y",), (None,), ("line\n@d",), ("@",)], "text string"
    )
    assert [r.mention for r in words.mentions(posts).collect()] == ["@a", "@c", "@"]


def test_posts_from_messages(spark):
    good = '{"created_at": "Mon Jan 01 10:20:30 +0100 2024", "id": 5, "id_str": "5", "text": "hi @a"}'
    df = files.inline(spark, [(good.encode(),), (b"no json",), (None,)], "value binary")
    found = mentions.posts_of_messages(df)
    assert found.count() == 3
    assert got(found.where("id = 5").select("text", F.col("timestamp").cast("timestamp_ntz"))) == [
        ("hi @a", datetime(2024, 1, 1, 9, 20, 30))
    ]
    assert got(mentions.trending(mentions.mention_windows(found)).select("mention", "count")) == [("@a", 1)]


def test_pivoted_counts_fill_zero(spark):
    df = files.inline(spark, [("a", 1), ("b", 2)], "k string, v int")
    assert sorted(got(pivoted_counts(df, "k", "v", [1, 2]))) == [("a", 1, 0), ("b", 0, 1)]


def test_csv_readers(spark, tmp_path):
    (tmp_path / "h").mkdir()
    for name in ("1", "2"):
        (tmp_path / "h" / f"{name}.csv").write_text("subject,score\nMath,7\n")
    as_text = files.csv_with_header(spark, str(tmp_path / "h"), files.text_columns("subject", "score"))
    assert got(as_text) == [("Math", "7")] * 2
    assert dict(files.csv_with_header(spark, str(tmp_path / "h"), infer=True).dtypes)["score"] == "int"
    (tmp_path / "p1.csv").write_text("1,2\n")
    (tmp_path / "p2.csv").write_text("3\n")
    both = files.csv_positional(spark, [str(tmp_path / "p1.csv"), str(tmp_path / "p2.csv")], "a int, b int")
    assert sorted(got(both)) == [(1, 2), (3, None)]
