"""The batch pipeline from raw files to served tables.

Each layer is written once and read back by the next, so that a lost executor or
a failed step never repeats more than one layer.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cartlake.operators import gold, learning, scoring, serving, silver
from cartlake.plans import dashboard
from cartlake.session import use_utc
from cartlake.sources import files, sinks
from cartlake.sources.jdbc import Database


SERVING_TABLES = ("session_features", "cart_coupons_prescribed")


@dataclass(frozen=True)
class Lake:
    """Where the layers live; any path Spark can write."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/ecommerce_events"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/ecommerce_events"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold/session_features"

    @property
    def models(self) -> str:
        """The comparison of the models of the last campaign."""
        return f"{self.root}/models/comparison"

    @property
    def serving(self) -> str:
        return f"{self.root}/serving"


def build_silver(spark: SparkSession, bronze: DataFrame, lake: Lake, **rules: bool) -> DataFrame:
    """``rules`` are the optional ``normalize`` and ``dedup``."""
    use_utc(spark)
    trusted = silver.with_month(silver.silver_events(bronze, **rules))
    sinks.write_layer(trusted, lake.silver, ["year", "month"])
    return spark.read.parquet(lake.silver)


def build_gold(spark: SparkSession, lake: Lake) -> DataFrame:
    use_utc(spark)
    sinks.write_layer(gold.gold_carts(spark.read.parquet(lake.silver)), lake.gold)
    return spark.read.parquet(lake.gold)


def medallion(spark: SparkSession, csv_path: str, lake: Lake, **rules: bool) -> DataFrame:
    """Bronze CSV to gold."""
    build_silver(spark, files.read_events_csv(spark, csv_path), lake, **rules)
    return build_gold(spark, lake)


def populate_serving(
    spark: SparkSession, lake: Lake, batch_id: int, model_path: str | None = None, database: Database | None = None
) -> tuple[DataFrame, DataFrame]:
    """Load session features and prescriptions. A batch replaces its own earlier
    try, and the newest row of a session wins on reading. Without a model the
    carts are scored by the heuristic. With a database its tables take the batch as well."""
    carts = spark.read.parquet(lake.gold)
    if model_path:
        model = learning.load_model(model_path)
        scored = scoring.with_recovery(scoring.with_coupon(learning.predict(model, carts)))
    else:
        scored = scoring.score(carts)
    tables = (serving.serving_session_features(carts), serving.serving_prescriptions(scored))
    loads = dict(zip(SERVING_TABLES, tables, strict=True))
    for name, rows in loads.items():
        sinks.append_batch(rows, f"{lake.serving}/{name}", batch_id)
        if database:
            written = spark.read.schema(rows.schema).parquet(f"{lake.serving}/{name}/batch_id={batch_id}")
            database.replace(written, name, "session_id", str(batch_id))
    tables = [sinks.read_latest(spark, f"{lake.serving}/{name}", "session_id") for name in loads]
    return tables[0], tables[1]


def publish_dashboard(spark: SparkSession, lake: Lake, path: str) -> DataFrame:
    """Models are reported if a campaign has left its comparison."""
    known = files.list_files(spark, f"{lake.models}/*.parquet")
    comparison = spark.read.parquet(lake.models) if known else None
    parts = dashboard.sections(spark.read.parquet(lake.silver), spark.read.parquet(lake.gold), comparison)
    document = dashboard.document(parts)
    sinks.write_document(document, path)
    return document
