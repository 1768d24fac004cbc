"""Month and timestamp expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month names in calendar order.
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)

# Fixed value: layout of a post's created_at text after its three-letter weekday and blank.
POST_TIME_LAYOUT = "MMM d HH:mm:ss Z yyyy"


def month_number(ts: Column) -> Column:
    return F.month(ts)


def month_name(number: Column) -> Column:
    """Month name of a month number. Cheap enough to apply after grouping by the number."""
    return F.element_at(F.array(*map(F.lit, MONTHS)), number)


def log_time(text: Column) -> Column:
    """Log timestamps as text, also with unpadded month and day (``2015-4-21 14:32:21``)."""
    return F.try_to_timestamp(text, F.lit("yyyy-M-d HH:mm:ss"))


def post_time(text: Column) -> Column:
    """``Mon Jan 01 10:00:00 +0000 2024`` as a timestamp. The weekday carries no information and is cut off."""
    return F.try_to_timestamp(F.substr(text, F.lit(5)), F.lit(POST_TIME_LAYOUT))


def to_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(micros: Column) -> Column:
    return F.timestamp_micros(micros)
