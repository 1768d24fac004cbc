"""Pass rules and score bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (lowest share of chapters watched, points), best band first; below the last band 0 points.
COMPLETION_BANDS = ((0.9, 10), (0.5, 4), (0.25, 2))

# Grade prefixes that pass, by subject and for all other subjects.
PASS_BY_SUBJECT = {"Biology": ("A",)}
PASS_OTHERWISE = ("A+", "B")


def banded(share: Column, bands: Sequence[tuple[float, int]] = COMPLETION_BANDS) -> Column:
    """Points of the first band whose lower edge (inclusive) the share reaches."""
    points = F
    for edge, value in bands:
        points = points.when(share >= edge, value)
    return points.otherwise(0)


def passed(
    grade: Column,
    subject: Column,
    by_subject: Mapping[str, Sequence[str]] = PASS_BY_SUBJECT,
    otherwise: Sequence[str] = PASS_OTHERWISE,
) -> Column:
    def any_prefix(prefixes: Sequence[str]) -> Column:
        return reduce(or_, (F.startswith(grade, F.lit(prefix)) for prefix in prefixes))

    rule = F
    for name, prefixes in by_subject.items():
        rule = rule.when(subject == name, any_prefix(prefixes))
    return rule.otherwise(any_prefix(otherwise))
