"""Words, titles and mentions."""

from functools import partial

from pyspark.sql import functions as F

from tidemark.catalog import stand_ins as given
from tidemark.catalog.registry import registered
from tidemark.functions.texts import STOP_WORDS
from tidemark.functions.times import post_time
from tidemark.operators.grouping import counted
from tidemark.operators.words import letter_words, mentions
from tidemark.plans import mentions as trend
from tidemark.plans import text_reports
from tidemark.sources.files import table
from tidemark.streaming.replay import replay_into

_WORDS = (
    "SELECT word FROM (SELECT unnest(string_split(line, ' ')) AS word "
    "FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) "
    "WHERE regexp_full_match(word, '[a-zA-Z]+')"
)
_STOPPED = ", ".join(f"'{word}'" for word in STOP_WORDS)
_KEYWORDS = (
    f"SELECT lower(word) AS word, count(*) AS count FROM ({_WORDS}) "
    "WHERE lower(word) NOT IN ({}) GROUP BY 1"
)


@registered("regex_words", _WORDS)
def regex_words(spark, folder):
    return letter_words(table(spark, folder, "documents"), "text")


@registered("word_ranking", _KEYWORDS.format(_STOPPED) + " ORDER BY count DESC, word LIMIT 100")
def word_ranking(spark, folder):
    return text_reports.top_keywords(table(spark, folder, "documents"), "text")


@registered(
    "word_ranking_listed",
    _KEYWORDS.format("SELECT DISTINCT event_type FROM events UNION SELECT lower(n_name) FROM nation")
    + " ORDER BY count DESC, word LIMIT 100",
)
def word_ranking_listed(spark, folder):
    """The same ranking with the stop words in tables."""
    listed = given.events(spark, folder).select(F.col("event_type").alias("word")).union(
        table(spark, folder, "nation").select(F.lower("n_name"))
    )
    return text_reports.top_keywords(table(spark, folder, "documents"), "text", stop_words=listed)


@registered(
    "title_word_count",
    """
    SELECT word, count(*) AS count
    FROM (SELECT unnest(CASE WHEN bare <> '' AND rtrim(bare, ' ') = '' THEN []
                             ELSE string_split(rtrim(bare, ' '), ' ') END) AS word
          FROM (SELECT regexp_replace(trim(lower(title)), '[[:punct:]]', '', 'g') AS bare
                FROM (SELECT CASE p_size % 10
                                  WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN '!?' WHEN 3 THEN '- -'
                                  WHEN 4 THEN 'The ' || p_name || ' - (' || p_brand || ') -'
                                  ELSE ' ' || p_name || ': "' || p_type || '"! ' END AS title FROM part)
                WHERE trim(title) <> ''))
    GROUP BY 1
    """,
)
def title_word_count(spark, folder):
    """Lines ``key,brand,title``, some without a title, with a blank one or one of punctuation only."""
    kind = F.col("p_size") % 10
    title = (
        F.when(kind == 1, "  ").when(kind == 2, "!?").when(kind == 3, "- -")
        .when(kind == 4, F.concat(F.lit("The "), "p_name", F.lit(" - ("), "p_brand", F.lit(") -")))
        .when(kind > 4, F.concat(F.lit(" "), "p_name", F.lit(': "'), "p_type", F.lit('"! ')))
    )
    lines = table(spark, folder, "part").select(F.concat_ws(",", "p_partkey", "p_brand", title).alias("value"))
    return text_reports.title_word_report(lines)


_POSTS = """
    SELECT event_id AS id, date_trunc('second', ts) AS timestamp,
           CASE WHEN event_id % 5 <> 0 THEN '@' || user_id END AS mention
    FROM events
"""
_TREND = f"""
    SELECT time_bucket(INTERVAL 5 minute, timestamp) AS window_start,
           time_bucket(INTERVAL 5 minute, timestamp) + INTERVAL 5 minute AS window_end,
           mention, count(*) AS count
    FROM ({_POSTS}) WHERE mention IS NOT NULL GROUP BY ALL
    ORDER BY count DESC, mention, window_start LIMIT 20
"""


@registered("parse_post_time", f"SELECT id, timestamp FROM ({_POSTS})")
def parse_post_time(spark, folder):
    posts = trend.posts_of_messages(given.post_messages(given.events(spark, folder)))
    return given.wall_clock(posts.select("id", post_time(F.col("created_at")).alias("timestamp")), "timestamp")


@registered(
    "mention_counts", f"SELECT mention, count(*) AS count FROM ({_POSTS}) WHERE mention IS NOT NULL GROUP BY 1"
)
def mention_counts(spark, folder):
    posts = trend.posts_of_messages(given.post_messages(given.events(spark, folder)))
    return counted(mentions(posts), "mention")


@registered("mention_top20", _TREND)
def mention_top20(spark, folder):
    posts = trend.posts_of_messages(given.post_messages(given.events(spark, folder)))
    return given.wall_clock(trend.trending(trend.mention_windows(posts)), "window_start", "window_end")


@registered("stream_mention_top20", _TREND)
def stream_mention_top20(spark, folder):
    """Ranked at every trigger by what keeps the ranking; the last one is shown."""
    kept = given.replayed(
        spark, folder, ["user_id", "event_id", "event_type"],
        lambda rows: trend.mention_windows(trend.posts_of_messages(given.post_messages(rows))),
        partial(replay_into, trend.trending_view, mode="update"),
    )
    return given.wall_clock(kept.current().drop("rank"), "window_start", "window_end")
