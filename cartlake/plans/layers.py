"""The layers of one data folder, each a plan that is built when asked for."""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from cartlake.operators import gold, scoring, silver
from cartlake.sources.testdata import bronze_events, table


class Layers:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def events(self) -> DataFrame:
        return table(self.spark, self.sf_dir, "events")

    @cached_property
    def bronze(self) -> DataFrame:
        return bronze_events(self.spark, self.sf_dir)

    @cached_property
    def silver(self) -> DataFrame:
        return silver.silver_events(self.bronze)

    @cached_property
    def base(self) -> DataFrame:
        """Gold without history; enough for the rules and most aggregates."""
        return gold.session_base(self.silver)

    @cached_property
    def gold(self) -> DataFrame:
        return gold.gold_carts(self.silver)

    @cached_property
    def heuristic(self) -> DataFrame:
        return scoring.score(self.base)

    @cached_property
    def logistic(self) -> DataFrame:
        """Scores that reach every tier of the coupon matrix."""
        return scoring.with_recovery(scoring.with_coupon(scoring.with_logistic_risk(self.base)))
