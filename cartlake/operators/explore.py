"""Filters, searches, listings and samples of the layers."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.functions.text import contains_any, folded
from cartlake.operators.running import TOP_ROWS, ranked_between

EVERYTHING = "ALL"


def filter_events(layer: DataFrame, event_type: str = EVERYTHING) -> DataFrame:
    return layer if event_type == EVERYTHING else layer.where(F.col("event_type") == event_type)


def filter_carts(layer: DataFrame, target: str = EVERYTHING) -> DataFrame:
    return layer if target == EVERYTHING else layer.where(F.col("is_abandoned") == int(target))


def search(layer: DataFrame, term: str) -> DataFrame:
    """Rows where any column holds the term."""
    return layer.where(contains_any(layer.columns, term)) if term.strip() else layer


def page(
    layer: DataFrame, sort_column: str, tie_breaker: str, number: int, size: int = 10, descending: bool = False,
    top_rows: int = TOP_ROWS,
) -> DataFrame:
    """One page of a sorted listing; a page past the end shows the last page. Pages that end
    beyond ``top_rows`` are found by ranges of the order."""
    pages = max(1, math.ceil(layer.count() / size))
    number = min(max(number, 1), pages)
    key = folded(sort_column, layer.schema[sort_column].dataType.simpleString())
    order = key.desc_nulls_last() if descending else key.asc_nulls_first()
    total = [order, F.col(tie_breaker).asc_nulls_first()]
    start = (number - 1) * size
    return ranked_between(layer, total, start, start + size, top_rows).orderBy(*total).limit(size)


def filter_matrix(
    scored: DataFrame,
    status: str = EVERYTHING,
    coupon_label: str = EVERYTHING,
    urgency: str = EVERYTHING,
    term: str = "",
) -> DataFrame:
    wanted: list[Column] = []
    if status in ("ABANDONED", "PURCHASED"):
        wanted.append(F.col("is_abandoned") == int(status == "ABANDONED"))
    if coupon_label != EVERYTHING:
        wanted.append(F.col("coupon_label") == coupon_label)
    if urgency != EVERYTHING:
        wanted.append(F.col("urgency_level") == urgency)
    if term.strip():
        wanted.append(contains_any(["user_session", "user_id", "coupon_label"], term))
    for condition in wanted:
        scored = scored.where(condition)
    return scored


def of_user(events: DataFrame, user_id: int) -> DataFrame:
    return events.where(F.col("user_id") == user_id)


def without_users(events: DataFrame, user_ids: list[int]) -> DataFrame:
    return events.where(~F.col("user_id").isin(user_ids))


def pin_users(layer: DataFrame, user_ids: list[int], *order: str) -> DataFrame:
    """The layer with these users' rows on top."""
    pinned = F.when(F.col("user_id").isin(user_ids), 0).otherwise(1)
    return layer.withColumn("priority", pinned).orderBy("priority", *order)


def sample(layer: DataFrame, *order: str, n: int = 100) -> DataFrame:
    """The first ``n`` rows of a total order, empty text for missing text."""
    return layer.orderBy(*order).limit(n).fillna("")
