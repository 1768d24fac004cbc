"""Course scores from who watched how much of which course."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.grades import COMPLETION_BANDS, banded
from tidemark.operators.grouping import counted
from tidemark.operators.rows import distinct_of, ranked


def course_scores(chapters: DataFrame, views: Sequence[DataFrame], titles: DataFrame,
                  bands: Sequence[tuple[float, int]] = COMPLETION_BANDS) -> DataFrame:
    """``score, title``, best first.

    ``chapters``: ``chapter_id, course_id``; ``views`` (any number of inputs): ``user_id, chapter_id``;
    ``titles``: ``course_id, title``. A user gets a course's points for the share of its chapters watched,
    each chapter counted once; a course's score is the sum over its users.

    The number of chapters is attached to the chapter list, so the views are joined once instead of twice,
    and they are reduced to one row per user and course before anything else happens to them.
    """
    watched = distinct_of(*(part.select("user_id", "chapter_id") for part in views))
    sizes = counted(chapters, "course_id", name="chapters")
    placed = chapters.join(sizes, "course_id").select("chapter_id", "course_id", "chapters")
    per_user = counted(watched.join(placed, "chapter_id"), "user_id", "course_id", "chapters", name="seen")
    points = banded(F.col("seen") / F.col("chapters").cast("double"), bands)
    scores = per_user.groupBy("course_id").agg(F.sum(points).alias("score"))
    return ranked(scores.join(titles, "course_id").select("score", "title"), "score", "title")
