"""Running totals on streams. They keep sums, so any split of the input into
micro-batches gives the totals of the whole."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.functions.events import CART, PURCHASE, VIEW
from cartlake.operators import kpis


def daily_funnel(silver: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """Event counts per day in tumbling windows."""
    kind = F.col("event_type")
    days = silver.withWatermark("event_time_ts", lateness).groupBy(F.window("event_time_ts", "1 day"))
    counts = days.agg(
        F.count_if(kind == VIEW).alias("views"),
        F.count_if(kind == CART).alias("carts"),
        F.count_if(kind == PURCHASE).alias("purchases"),
    )
    return counts.select(
        F.date_format("window.start", "yyyy-MM-dd").alias("day"), "views", "carts", "purchases"
    )


def running_kpis(scored: DataFrame) -> DataFrame:
    """Cart KPIs, recovered value and mean views over all carts so far."""
    views, carts = F.sum("num_views_before_cart"), F.count(F.lit(1))
    return scored.agg(
        carts.alias("total_carts"),
        F.count_if(kpis.abandoned()).alias("abandoned_carts"),
        kpis.rate(F.count_if(kpis.abandoned()), carts).alias("abandonment_rate"),
        kpis.money_sum("total_cart_value").alias("total_gmv"),
        kpis.money_sum("total_cart_value", kpis.abandoned()).alias("gmv_lost"),
        kpis.money_sum("recovered_money", kpis.abandoned()).alias("gmv_recovered"),
        kpis.rate(views, carts, 2).alias("mean_views"),
    )
