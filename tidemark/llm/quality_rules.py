"""Quality rules: a threshold table compiled into one projection of Spark functions.

A word is a run of characters other than blank and 0x09 to 0x0D; a line ends at ``\\n``. Null counts as an empty
text: no words, no lines with a word, rejected for want of words. Texts of any length are measured whole, repeated rows
alike. An empty table gives no rows. Documents travel as one struct, so their columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Frequent words of the languages kept, compared in lower case without the marks at their end.
STOP_WORDS = (
    "the and of to in is that it for on with as be by this are was "
    "le la les de des et en un une que qui dans pour sur du "
    "el los las y por con para se una su del "
    "der die das und ist nicht von den mit auf sich ein eine im dem zu"
).split()

#: (name, measure, least, most): a document is kept if every measure lies within its bounds.
THRESHOLDS = (
    ("words", "n_words", 50, None),
    ("word_length", "mean_word_chars", 2.0, 15.0),
    ("symbols", "symbol_ratio", None, 0.1),
    ("stop_words", "stop_word_ratio", 0.04, None),
    ("bullets", "bullet_line_ratio", None, 0.9),
    ("ellipses", "ellipsis_line_ratio", None, 0.3),
    ("repeated_lines", "dup_line_ratio", None, 0.5),
    ("repeated_words", "repeat_word_ratio", None, 0.5),
    ("alphabetic", "alpha_word_ratio", 0.7, None),
)


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def repeated_window_words(words: Column, width: int = 3) -> Column:
    """Number of words inside a window of ``width`` words that occurs at least twice.

    Windows are sorted by hash, which brings equal ones side by side, then walked once in text order.
    """
    def windows(w):
        hashed = lambda i: F.struct(F.xxhash64(*[F.get(w, i + k) for k in range(width)]).alias("h"), i.alias("p"))
        return F.transform(F.sequence(F.lit(0), F.size(w) - width), hashed)

    def twice(s):
        same = lambda x, i: F.coalesce(x.h == F.get(s, i).h, F.lit(False))
        return F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1))

    def covered(places):
        start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        step = lambda a, p: F.struct((p + width).alias("end"), (a.n + width - F.greatest(a.end - p, F.lit(0))).alias("n"))
        return F.aggregate(places, start, step, lambda a: a.n)

    places = bound(F.sort_array(bound(words, windows)), lambda s: F.sort_array(F.transform(twice(s), lambda x: x.p)))
    return F.when(F.size(words) > width, covered(places)).otherwise(F.lit(0).cast("long"))


def measures(text: Column) -> tuple[dict[str, Column], dict[str, Column], dict[str, Column]]:
    """Lists first, then counts over them, then ratios of counts, each as named columns over the ones before."""
    body = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    lists = {"q_words": words_of(text), "q_lines": lines}
    words, kept_lines = F.col("q_words"), F.col("q_lines")
    plain = lambda w: F.regexp_replace(F.lower(w), r"[.,;:!?]+$", "")
    counts = {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.translate(body, BLANKS, "")).cast("long"),
        "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size(kept_lines) - F.size(F.array_distinct(kept_lines))).cast("long"),
        "n_repeat_words": repeated_window_words(words),
        "n_stop_words": F.size(F.filter(words, lambda w: plain(w).isin(STOP_WORDS))).cast("long"),
        "n_alpha_words": F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))).cast("long"),
        "n_lines": F.size(kept_lines).cast("long"),
        "n_bullet_lines": F.size(F.filter(kept_lines, lambda x: x.rlike("^[\\x20\\t]*[-*•]"))).cast("long"),
        "n_ellipsis_lines": F.size(F.filter(kept_lines, lambda x: x.rlike("(\\.\\.\\.|…)[\\x20\\t\\r]*$"))).cast("long"),
    }
    share = lambda part, whole: F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0))
    ratios = {
        "mean_word_chars": share("word_chars", "n_words"),
        "symbol_ratio": share("n_symbols", "n_words"),
        "stop_word_ratio": share("n_stop_words", "n_words"),
        "alpha_word_ratio": share("n_alpha_words", "n_words"),
        "repeat_word_ratio": share("n_repeat_words", "n_words"),
        "dup_line_ratio": share("n_dup_lines", "n_lines"),
        "bullet_line_ratio": share("n_bullet_lines", "n_lines"),
        "ellipsis_line_ratio": share("n_ellipsis_lines", "n_lines"),
    }
    return lists, counts, ratios


def verdict(thresholds=THRESHOLDS) -> Column:
    """The table as one condition."""
    kept = F.lit(True)
    for _, measure, least, most in thresholds:
        if least is not None:
            kept = kept & (F.col(measure) >= least)
        if most is not None:
            kept = kept & (F.col(measure) <= most)
    return kept


def judged(docs: DataFrame, text: str = "text", thresholds=THRESHOLDS) -> DataFrame:
    """The documents with their measures and ``passes``. A column of the input with such a name is replaced."""
    lists, counts, ratios = measures(docs[text])
    frame = docs.withColumns(lists).withColumns(counts).drop(*lists)
    return frame.withColumns(ratios).withColumn("passes", verdict(thresholds))


def passing(docs: DataFrame, text: str = "text", thresholds=THRESHOLDS) -> DataFrame:
    """The documents that pass, with the columns they came with.

    The row number keeps the condition above the projection, which would else be computed once per rule.
    """
    names = docs.columns
    held = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), docs[text].alias("q_text"))
    numbered = judged(held, "q_text", thresholds).withColumn("q_number", F.monotonically_increasing_id())
    return numbered.where("passes AND q_number >= 0").select("row.*")
