"""Gold and buyers' histories kept up to date batch by batch.

A micro-batch of silver events costs its own events, the earlier sums of the sessions in it and
the carts of their buyers; it never reads silver again. All tables are tiered logs: a batch that
runs again after a failure gives the same folders.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from cartlake.operators import gold, triggers
from cartlake.schemas import GOLD_COLUMNS
from cartlake.session import stage
from cartlake.sources.log import BUCKETS, FAN, TieredLog, newest

# Columns that gold has beyond its base.
HISTORY = {
    "user_prior_views": "long",
    "user_prior_carts": "long",
    "user_prior_abandoned_carts": "long",
    "user_total_cumulative_views": "long",
    "user_lifetime_hours": "double",
    "user_prior_abandon_rate": "double",
}
GOLD_OUTPUT = [*GOLD_COLUMNS, "first_event_sec", "first_cart_sec", "last_cart_sec"]


def nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType) for f in schema.fields])


def summed_seconds(rows: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("views", "carts")]
    return rows.groupBy("user_id", "user_session", "sec").agg(*sums)


class LiveGold:
    """The incremental form of ``gold.gold_carts``.

    ``parts``: partial sums per (session, facet, value) of each batch, by session. ``carts``: a
    version of a cart session's row whenever it changes, by buyer; ``gone`` where a late first
    event gave the session to another buyer. ``gold``: the rows with history that a batch changed.
    ``seconds``: each buyer's views and carts per second, for histories as of a point in time.
    """

    def __init__(self, spark: SparkSession, root: str, silver_schema: StructType, buckets: int = BUCKETS, fan: int = FAN):
        self.spark, self.root = spark, root
        silver = spark.createDataFrame([], silver_schema)
        parts = gold.session_parts(silver)
        base = gold.base_of_parts(parts)
        versions = base.select("*", F.lit(False).alias("gone"), F.lit(0).cast("long").alias("version"))
        done = base.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in HISTORY.items()])

        def log(name: str, rows: DataFrame, key: str, merge) -> TieredLog:
            return TieredLog(spark, f"{root}/{name}", nullable(rows.schema), key, merge, buckets, fan)

        self.parts = log("parts", parts, "user_session", gold.merged_parts)
        self.carts = log("carts", versions, "user_id", lambda r: newest(r, ["user_id", "user_session"]))
        self.gold = log(
            "gold", done.select(*GOLD_OUTPUT, F.lit(0).cast("long").alias("version")), "user_session",
            lambda r: newest(r, ["user_session"]),
        )
        self.seconds = log("seconds", triggers.buyer_seconds(silver), "user_id", summed_seconds)

    def update(self, silver: DataFrame, batch_id: int) -> DataFrame:
        """Take in a batch of silver events; returns the gold rows that it changed."""
        self.seconds.append(triggers.buyer_seconds(silver), batch_id)
        carts = self.changed_carts(self.parts.append(gold.session_parts(silver), batch_id), batch_id)
        return self.with_history(self.carts.append(carts, batch_id), batch_id)

    def changed_carts(self, delta: DataFrame, batch_id: int) -> DataFrame:
        """New versions of the cart sessions in a batch, from the sums of all batches."""
        sessions = delta.select("user_session").distinct()
        before = self.parts.read(batch_id - 1, self.parts.touched(sessions)).join(sessions, "user_session", "left_semi")
        met = stage(
            before.withColumn("old", F.lit(True)).unionByName(delta.withColumn("old", F.lit(False))), "touched-parts"
        )
        after = gold.base_of_parts(gold.merged_parts(met.drop("old")))
        old = met.where("old").groupBy("user_session").agg(
            F.min_by("owner", "first_order").alias("old_user"),
            F.min("first_sec").alias("old_sec"),
            F.sum("items").alias("old_items"),
        )
        old = old.where("old_items > 0").drop("old_items")
        both = stage(after.join(old, "user_session", "left"), "touched-carts")
        same = {"gone": F.lit(False), "version": F.lit(batch_id).cast("long")}
        # A first event only moves to earlier; a session that it gives to another buyer leaves
        # a mark with the old one, where it stood.
        left = both.where("old_user <> user_id").withColumns({"user_id": F.col("old_user"), "first_event_sec": F.col("old_sec")})
        columns = self.carts.columns
        return both.withColumns(same).select(*columns).unionByName(left.withColumns({**same, "gone": F.lit(True)}).select(*columns))

    def with_history(self, delta: DataFrame, batch_id: int) -> DataFrame:
        """Gold of the buyers in ``delta``, from their first changed cart on: what lies before it
        has the history that it had."""
        place = F.struct("first_event_sec", "user_session")
        buyers = stage(delta.groupBy("user_id").agg(F.min(place).alias("first")), "touched-buyers")
        held = self.carts.read(batch_id, self.carts.touched(buyers)).join(buyers, "user_id")
        rows = newest(held, ["user_id", "user_session"]).where("not gone").drop("gone", "version")
        done = gold.with_history(rows).where(F.struct("first_event_sec", "user_session") >= F.col("first"))
        return self.gold.append(done.select(*GOLD_OUTPUT, F.lit(batch_id).cast("long").alias("version")), batch_id)

    def read(self, last: int | None = None) -> DataFrame:
        """Gold after batch ``last``: equal to ``gold_carts`` over the events up to it."""
        last = self.gold.last() if last is None else last
        return newest(self.gold.read(last), ["user_session"]).select(*GOLD_OUTPUT)

    def first_seconds(self, sessions: DataFrame) -> DataFrame:
        """(user_session, first_sec) of some sessions, from narrow columns of their buckets."""
        rows = self.parts.read(self.parts.last(), self.parts.touched(sessions)).select("user_session", "first_sec")
        return rows.join(sessions.select("user_session").distinct(), "user_session", "left_semi").groupBy("user_session").agg(
            F.min("first_sec").alias("first_sec")
        )

    def seconds_of(self, buyers: DataFrame) -> DataFrame:
        """The seconds of some buyers."""
        rows = self.seconds.read(self.seconds.last(), self.seconds.touched(buyers))
        return summed_seconds(rows.join(buyers.select("user_id").distinct(), "user_id", "left_semi"))
