"""Event logs and layers on any Hadoop path."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartlake.operators.running import TOP_ROWS, ranked_between
from cartlake.schemas import BRONZE, TRAINING

# Folders of a layer that is loaded file by file.
SOURCE_FILE = "source_file"


def read_events_csv(
    spark: SparkSession, path: str | list[str], schema: StructType = BRONZE
) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def read_events_json(
    spark: SparkSession, path: str | list[str], schema: StructType = BRONZE
) -> DataFrame:
    return spark.read.schema(schema).json(path)


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, whichever the path names."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Sorted paths matching a glob."""
    path, system = hadoop_path(spark, pattern)
    return sorted(status.getPath().toString() for status in system.globStatus(path) or [])


def ensure_folder(spark: SparkSession, path: str) -> None:
    folder, system = hadoop_path(spark, path)
    system.mkdirs(folder)


def exists(spark: SparkSession, path: str) -> bool:
    place, system = hadoop_path(spark, path)
    return system.exists(place)


def put_mark(spark: SparkSession, path: str) -> None:
    """An empty file."""
    place, system = hadoop_path(spark, path)
    system.create(place, True).close()


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def sample_files(
    parts: list[DataFrame], order: list[str], sample_n: int | None, top_rows: int = TOP_ROWS
) -> DataFrame:
    """``sample_n // len(parts)`` rows from each part, first in ``order``; all
    rows when no size is given. The total order makes the sample repeatable."""
    if sample_n is not None:
        per_part = sample_n // len(parts)
        if per_part < 1:
            raise ValueError(f"a sample of {sample_n} rows is less than one for each of {len(parts)} parts")
        total = [F.col(c).asc_nulls_first() for c in order]
        parts = [ranked_between(part, total, 0, per_part, top_rows) for part in parts]
    return union_all(parts)


def load_events(
    spark: SparkSession,
    folder: str,
    sample_n: int | None = None,
    file_pattern: str | None = None,
) -> DataFrame:
    """The CSV logs of a folder, or of the files whose path has ``file_pattern``; all rows
    unless a sample is asked for. A sample takes equally many rows of each file, so with n files
    it can be up to n - 1 rows short of ``sample_n``."""
    paths = list_files(spark, f"{folder}/*.csv")
    if not paths:
        raise FileNotFoundError(f"no .csv file in {folder}")
    if file_pattern:
        paths = [p for p in paths if file_pattern in p]
        if not paths:
            raise FileNotFoundError(f"no .csv file in {folder} has {file_pattern!r} in its path")
    if sample_n is None:
        return read_events_csv(spark, paths)
    parts = [read_events_csv(spark, path) for path in paths]
    return sample_files(parts, BRONZE.names, sample_n)


def first_existing(spark: SparkSession, candidates: list[str]) -> str:
    """The first path or glob that matches a file: root log, then folder, ..."""
    for candidate in candidates:
        if list_files(spark, candidate):
            return candidate
    raise FileNotFoundError(f"none of these exists: {candidates}")


def read_layer(spark: SparkSession, path: str, fallback: str | None = None) -> DataFrame:
    """All Parquet files below a prefix; the fallback when the prefix has none. The folders by
    source file, which loads replace, are no column of the layer."""
    try:
        return spark.read.parquet(path).drop(SOURCE_FILE)
    except AnalysisException as error:
        if fallback is None or error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.read.parquet(fallback).drop(SOURCE_FILE)


def read_user_events(
    spark: SparkSession, path: str, user_id: int, schema: StructType = BRONZE
) -> DataFrame:
    return read_events_csv(spark, path, schema).where(F.col("user_id") == user_id)


def read_training_table(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Columns are taken by position from CSV, so a header in another order is an error."""
    reader = spark.read.schema(TRAINING).option("enforceSchema", False)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.parquet(path)
