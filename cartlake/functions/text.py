"""Text expressions for listings and searches."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_any(columns: list[str], term: str) -> Column:
    """True if some column holds ``term``, ignoring case; nulls never match."""
    wanted = F.lit(term.lower().strip())
    hits = [
        F.coalesce(F.lower(F.col(c).cast("string")).contains(wanted), F.lit(False))
        for c in columns
    ]
    return reduce(lambda a, b: a | b, hits)


def folded(column: str, dtype: str) -> Column:
    """Sort key of a listing: text without case, nulls as empty text."""
    if dtype == "string":
        return F.lower(F.coalesce(F.col(column), F.lit("")))
    return F.col(column)


def money(amount: Column) -> Column:
    return F.concat(F.lit("R$ "), F.format_number(amount, 2))


def percent(p: Column) -> Column:
    return F.format_string("%.1f%%", F.round(p * 100, 1))


def shortened(text: Column, length: int) -> Column:
    return F.concat(F.substring(text, 1, length), F.lit("..."))
