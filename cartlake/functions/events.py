"""Expressions on single events."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the event log.
VIEW = "view"
CART = "cart"
PURCHASE = "purchase"
EVENT_TYPES = (VIEW, CART, PURCHASE)
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
TIME_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
TIME_LENGTH = 19
UNKNOWN_CATEGORY = "outros.desconhecido"
UNKNOWN_BRAND = "generico"
OTHER_CATEGORY = "other"
NIGHT_FROM_HOUR = 22
NIGHT_UNTIL_HOUR = 6


def clean_time_text(event_time: Column) -> Column:
    return F.substring(event_time, 1, TIME_LENGTH)


def parse_time(event_time: Column) -> Column:
    """Null for unreadable text; ``to_timestamp`` would fail the job under ANSI.

    A cast parses several times faster than a pattern but takes more spellings,
    so the shape of the text is checked first.
    """
    text = clean_time_text(event_time)
    return F.when(text.rlike(TIME_SHAPE), text.try_cast("timestamp"))


def night_flag(hour: Column) -> Column:
    night = (hour >= NIGHT_FROM_HOUR) | (hour < NIGHT_UNTIL_HOUR)
    return F.when(night, 1).otherwise(0)


def weekend_flag(weekday: Column) -> Column:
    """Weekdays count from Monday = 0."""
    return F.when(weekday >= 5, 1).otherwise(0)


def to_cents(price: Column) -> Column:
    """Whole cents: sums stay exact, independent of row order, and in long buffers."""
    return (price.cast("decimal(18,2)") * 100).cast("long")


def from_cents(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100.0)


def event_order(seconds: Column, event_id: Column) -> Column:
    """(time, event id) as one sortable number.

    A struct would be a variable-length aggregation buffer and turn the hash
    aggregation over all events into a sort aggregation. Ids span 2^64, about
    1.8 x 10^19, so seconds are 2 x 10^19 apart.
    """
    wide = seconds.cast("decimal(19,0)") * F.lit(Decimal(2 * 10**19))
    return (wide + event_id.cast("decimal(19,0)")).cast("decimal(38,0)")


def hours_between(later_sec: Column, earlier_sec: Column) -> Column:
    return (later_sec - earlier_sec) / F.lit(3600.0)


def leading_category(category: Column) -> Column:
    """The first part of a dotted category path; the whole text without a dot."""
    return F.split_part(category, F.lit("."), F.lit(1))
