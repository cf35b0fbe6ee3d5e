"""Session settings and the staging of intermediate tables."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Folders of local sessions without a shared one, by application.
LOCAL_FOLDERS: dict[str, str] = {}
# Staged paths, by application.
STAGED: dict[str, list[str]] = {}


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are UTC text, so hours and dates must be taken in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(app: str = "cartlake", cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster, use the cluster's own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session without the setting gets a folder of its own. A cluster
    without it is an error: a folder on the driver would be invisible to the
    executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in LOCAL_FOLDERS:
        LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="cartlake-")
    return LOCAL_FOLDERS[application]


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_staged(spark: SparkSession) -> None:
    """At a job's end: remove what this application staged. Tables read from it are gone."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in STAGED.pop(spark.sparkContext.applicationId, []):
        staged = hadoop.Path(path)
        staged.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(staged, True)


def write_stage(df: DataFrame, label: str) -> str:
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For a table that several branches of one plan read: without it, each branch
    would scan and shuffle the raw events again, because column pruning gives
    the branches different exchanges. The files survive lost executors.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_stage(df, label))
