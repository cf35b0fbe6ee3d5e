"""Counts, rates and sums over events and carts."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlake.functions.events import CART, PURCHASE, VIEW, from_cents, to_cents
from cartlake.functions.offers import NO_COUPON
from cartlake.functions.risk import PREDICTED_ABANDONED_FROM
from cartlake.operators.running import exact_quantiles
from cartlake.session import stage



def one() -> Column:
    return F.lit(1)


def abandoned() -> Column:
    return F.col("is_abandoned") == 1


def money_sum(amount: str, condition: Column | None = None) -> Column:
    """Exact sum of a money column over the rows that meet the condition; 0 for none."""
    cents = to_cents(F.col(amount))
    if condition is not None:
        cents = F.when(condition, cents)
    return from_cents(F.coalesce(F.sum(cents), F.lit(0)))


def rate(part: Column, whole: Column, digits: int = 4) -> Column:
    return F.round(F.try_divide(part, whole), digits)


def funnel(silver: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return silver.agg(
        F.count_if(kind == VIEW).alias("views"),
        F.count_if(kind == CART).alias("carts"),
        F.count_if(kind == PURCHASE).alias("purchases"),
    )


# Fixed value: views of the whole log per view of a cart session.
VIEWS_PER_CART_VIEW = 3.5


def funnel_from_gold(carts: DataFrame) -> DataFrame:
    """A rough funnel where silver is not at hand."""
    views = F.coalesce(F.sum("num_views_before_cart"), F.lit(0)) * F.lit(VIEWS_PER_CART_VIEW)
    return carts.agg(
        F.floor(views).cast("long").alias("views"),
        F.count(one()).alias("carts"),
        F.count_if(~abandoned()).alias("purchases"),
    )


def funnel_by_day(silver: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    daily = silver.groupBy(F.date_format("event_time_ts", "yyyy-MM-dd").alias("day")).agg(
        F.count_if(kind == VIEW).alias("views"),
        F.count_if(kind == CART).alias("carts"),
        F.count_if(kind == PURCHASE).alias("purchases"),
    )
    return daily.select(
        "*",
        rate(F.col("carts"), F.col("views")).alias("view_to_cart_rate"),
        rate(F.col("purchases"), F.col("carts")).alias("cart_to_purchase_rate"),
    )


def cart_kpis(carts: DataFrame) -> DataFrame:
    return carts.agg(
        F.count(one()).alias("total_carts"),
        F.count_if(abandoned()).alias("abandoned_carts"),
        rate(F.count_if(abandoned()), F.count(one())).alias("abandonment_rate"),
        money_sum("total_cart_value").alias("total_gmv"),
        money_sum("total_cart_value", abandoned()).alias("gmv_lost"),
    )


def recovery_kpis(scored: DataFrame) -> DataFrame:
    """What the offers are expected to bring back from the abandoned carts."""
    eligible = abandoned() & (F.col("coupon_code") != NO_COUPON)
    return scored.agg(
        F.count_if(eligible).alias("coupon_eligible"),
        money_sum("total_cart_value", abandoned()).alias("gmv_abandoned"),
        money_sum("recovered_money", eligible).alias("gmv_recovered"),
    )


def gmv_at_risk(scored: DataFrame) -> DataFrame:
    risky = F.col("p_abandonment") >= PREDICTED_ABANDONED_FROM
    totals = scored.agg(
        money_sum("total_cart_value").alias("gmv_total"),
        money_sum("total_cart_value", risky).alias("gmv_at_risk"),
        money_sum("recovered_money").alias("gmv_recovered"),
    )
    floor = F.greatest(F.lit(1.0), F.col("gmv_at_risk"))
    return totals.withColumn("recovery_rate", F.round(F.col("gmv_recovered") / floor, 4))


def coupon_distribution(scored: DataFrame) -> DataFrame:
    """The total is a window over one row per coupon."""
    counts = scored.groupBy("coupon_code", "coupon_label").agg(F.count(one()).alias("carts"))
    total = F.sum("carts").over(Window.partitionBy())
    return counts.withColumn("share", F.round(F.col("carts") / total, 4))


def abandonment_by(carts: DataFrame, *keys: Column) -> DataFrame:
    return carts.groupBy(*keys).agg(
        F.count(one()).alias("carts"),
        F.count_if(abandoned()).alias("abandoned"),
        rate(F.count_if(abandoned()), F.count(one())).alias("abandonment_rate"),
        rate(F.count_if(~abandoned()), F.count(one())).alias("conversion_rate"),
    )


def hourly_abandonment(carts: DataFrame) -> DataFrame:
    return carts.groupBy("hour_of_day").agg(
        F.count(one()).alias("carts"),
        rate(F.count_if(abandoned()), F.count(one()), 3).alias("abandonment_rate"),
    )


def top_abandoned_categories(carts: DataFrame, n: int = 5) -> DataFrame:
    counts = carts.where(abandoned()).groupBy("main_category").agg(F.count(one()).alias("carts"))
    return counts.orderBy(F.desc("carts"), "main_category").limit(n)


def conversion_by_category(carts: DataFrame) -> DataFrame:
    return abandonment_by(carts, F.col("main_category"))


def conversion_by_brand(silver: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    counts = silver.groupBy("brand").agg(
        F.count_if(kind == VIEW).alias("views"),
        F.count_if(kind == CART).alias("carts"),
        F.count_if(kind == PURCHASE).alias("purchases"),
        money_sum("price", kind == PURCHASE).alias("revenue"),
    )
    return counts.withColumn("cart_to_purchase_rate", rate(F.col("purchases"), F.col("carts")))


# Lower ends of the cart value bands: the thresholds of the offers.
BANDS = [0, 100, 300, 400, 500, 800]


def price_band_abandonment(carts: DataFrame) -> DataFrame:
    band = F.lit(BANDS[0])
    for low in BANDS[1:]:
        band = F.when(F.col("total_cart_value") >= low, low).otherwise(band)
    return abandonment_by(carts, band.alias("value_from"))


def abandonment_by_prior_carts(gold: DataFrame) -> DataFrame:
    bucket = F.least(F.col("user_prior_carts"), F.lit(3)).cast("int")
    return abandonment_by(gold, bucket.alias("prior_carts"))


def prior_activity_stats(gold: DataFrame) -> DataFrame:
    """Mean and exact median of earlier views and carts over all carts."""
    names = {"user_prior_views": "prior_views", "user_prior_carts": "prior_carts"}
    pairs = F.create_map(*[x for c, name in names.items() for x in (F.lit(name), F.col(c))])
    rows = stage(gold.select(F.explode(pairs).alias("metric", "v")), "prior-activity")
    means = rows.groupBy("metric").agg(F.round(F.avg("v"), 4).alias("mean"))
    medians = exact_quantiles(rows, F.col("v"), [0.5], ["metric"]).withColumnRenamed("q0", "median")
    both = means.join(medians, "metric")
    return both.agg(
        *[
            F.max(F.when(F.col("metric") == name, F.col(side))).alias(f"{name}_{side}")
            for name in names.values()
            for side in ("mean", "median")
        ]
    )


def uniques(silver: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return silver.agg(
        count("user_id").alias("buyers"),
        count("user_session").alias("sessions"),
        F.count(one()).alias("events"),
    )


def load_stats(events: DataFrame, carts: DataFrame) -> DataFrame:
    """Files, bytes and rows read, and carts found. ``events`` must come straight
    from files."""
    files = (
        events.select("_metadata.file_path", "_metadata.file_size")
        .groupBy("file_path")
        .agg(F.max("file_size").alias("bytes"), F.count(one()).alias("rows"))
        .agg(
            F.count(one()).alias("files"),
            F.sum("bytes").alias("bytes"),
            F.sum("rows").alias("rows"),
        )
    )
    return files.withColumn("carts", carts.agg(F.count(one())).scalar())


def kpis_by_day(scored: DataFrame) -> DataFrame:
    """What each day adds to the totals; sums of days are the totals."""
    day = F.date_format(F.timestamp_seconds("last_cart_sec"), "yyyy-MM-dd").alias("day")
    return scored.groupBy(day).agg(
        F.count(one()).alias("carts"),
        F.count_if(abandoned()).alias("abandoned"),
        F.sum("num_views_before_cart").alias("views"),
        F.sum(to_cents(F.col("total_cart_value"))).alias("gmv"),
        F.coalesce(F.sum(F.when(abandoned(), to_cents(F.col("total_cart_value")))), F.lit(0)).alias("lost"),
        F.coalesce(F.sum(F.when(abandoned(), to_cents(F.col("recovered_money")))), F.lit(0)).alias("recovered"),
    )


def kpi_increment(scored: DataFrame) -> DataFrame:
    """The running totals after each day. The window orders one row per day."""
    so_far = Window.partitionBy().orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    days = kpis_by_day(scored)
    return days.select(
        "day",
        F.sum("carts").over(so_far).alias("total_carts"),
        F.sum("abandoned").over(so_far).alias("abandoned_carts"),
        from_cents(F.sum("gmv").over(so_far)).alias("total_gmv"),
        from_cents(F.sum("lost").over(so_far)).alias("gmv_lost"),
        from_cents(F.sum("recovered").over(so_far)).alias("gmv_recovered"),
    ).withColumn("abandonment_rate", rate(F.col("abandoned_carts"), F.col("total_carts")))


def running_mean(scored: DataFrame) -> DataFrame:
    """Mean views per cart after each day, from sums, never from rounded means."""
    so_far = Window.partitionBy().orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    views, carts = F.sum("views").over(so_far), F.sum("carts").over(so_far)
    return kpis_by_day(scored).select("day", carts.alias("carts"), F.round(views / carts, 2).alias("mean_views"))
