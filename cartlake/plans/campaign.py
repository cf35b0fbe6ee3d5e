"""From gold to a trained model, and to what its offers would recover."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlake.operators import journey, kpis, learning, scoring
from cartlake.plans.medallion import Lake
from cartlake.session import stage
from cartlake.sources import sinks


@dataclass
class Campaign:
    """What a run reports; each entry is a small table but ``scored``."""

    uniques: DataFrame
    journey: DataFrame
    carts: DataFrame
    models: DataFrame
    best_model: str
    scored: DataFrame
    coupons: DataFrame
    gmv: DataFrame


def run_campaign(spark: SparkSession, lake: Lake, model_path: str | None = None) -> Campaign:
    """Train on four fifths of the carts, choose the best model, and score the
    carts it has not seen."""
    silver, gold = spark.read.parquet(lake.silver), spark.read.parquet(lake.gold)
    trained = learning.train_models(gold, save_to=model_path)
    sinks.write_layer(trained.comparison.coalesce(1), lake.models)
    unseen = learning.with_split(gold).where(F.col("split") == "test").drop("split")
    predicted = learning.predict(trained.best, unseen)
    scored = stage(scoring.with_recovery(scoring.with_coupon(predicted)), "campaign")
    return Campaign(
        uniques=kpis.uniques(silver),
        journey=journey.journey_stats(journey.buyer_journey(silver)),
        carts=kpis.cart_kpis(gold),
        models=trained.comparison,
        best_model=trained.best_name,
        scored=scored,
        coupons=kpis.coupon_distribution(scored),
        gmv=kpis.gmv_at_risk(scored),
    )
