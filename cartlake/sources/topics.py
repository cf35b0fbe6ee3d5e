"""Event messages: JSON text, one event per message."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartlake.schemas import BRONZE

EVENT_TOPIC = "ecommerce.cart.events"


def decode(messages: DataFrame, value: Column, schema: StructType = BRONZE) -> DataFrame:
    event = F.from_json(value.cast("string"), schema)
    return messages.select(event.alias("event")).select("event.*")


def encode(events: DataFrame) -> DataFrame:
    return events.select(F.to_json(F.struct("*")).alias("value"))


def read_topic(
    spark: SparkSession, servers: str, topic: str = EVENT_TOPIC, schema: StructType = BRONZE
) -> DataFrame:
    """A stream of events from a broker; needs the Kafka connector on the cluster."""
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .load()
    )
    return decode(messages, F.col("value"), schema)


def read_event_files(
    spark: SparkSession, path: str, schema: StructType = BRONZE, files_per_batch: int | None = None
) -> DataFrame:
    """A stream of events from JSON-lines files, where no broker is at hand."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)
