"""Writers of layers, documents and serving tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlake.sources.files import SOURCE_FILE, read_events_csv


def write_layer(
    df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite"
) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def write_document(document: DataFrame, path: str) -> None:
    """A one-row, one-column table as a text file."""
    document.write.mode("overwrite").text(path)


def ingest_csv(spark: SparkSession, source: str, bronze_path: str) -> None:
    """Land CSV logs in the bronze layer as Parquet, unchanged, in one folder per file of the
    source. A file that is loaded again replaces its own folder, under whatever pattern it was
    named, so no row is there twice."""
    rows = read_events_csv(spark, source).withColumn(SOURCE_FILE, F.md5(F.col("_metadata.file_path")))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SOURCE_FILE).parquet(bronze_path)


def latest_per_key(df: DataFrame, key: str, version: str) -> DataFrame:
    """The row with the highest version of each key, merged map-side first."""
    columns = [c for c in df.columns if c != key]
    newest = df.groupBy(key).agg(
        F.max_by(F.struct(*columns), F.struct(version, *[c for c in columns if c != version])).alias("row")
    )
    return newest.select(key, "row.*").select(*df.columns)


def append_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One folder per micro-batch; a batch that is run again replaces its own."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_latest(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The newest row of each key over all batches: a keyed upsert on read, so
    that no batch has to rewrite the table."""
    return latest_per_key(spark.read.parquet(path), key, "batch_id")
