"""Tables that grow by one folder per micro-batch and are merged in tiers."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartlake.sources.files import hadoop_path

BUCKETS, FAN = 64, 8


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")




class TieredLog:
    """One folder per batch; every ``fan`` folders of a tier are merged into one of the next.

    Which folders make up the table after batch n follows from n alone: the digits of n + 1
    in base ``fan``. A merged folder counts from the moment its write is committed, until then
    its parts do, so a reader sees old folders or the new one, never both. A batch that runs
    again writes the same folders again. Parts stay for ``fan`` more batches, for readers that
    have begun. Rows lie in folders by ``bucket`` of a key, so a batch that touches few keys
    reads few of them.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        key: str,
        merge: Callable[[DataFrame], DataFrame],
        buckets: int = BUCKETS,
        fan: int = FAN,
    ):
        self.spark, self.path, self.key, self.merge = spark, path, key, merge
        self.columns = [f.name for f in schema.fields]
        self.schema = StructType(list(schema.fields)).add("tier", "integer").add("start", "long").add("bucket", "integer")
        self.buckets, self.fan = buckets, fan

    def folder(self, tier: int, start: int) -> str:
        return f"{self.path}/tier={tier}/start={start}"

    def committed(self, tier: int, start: int) -> bool:
        path, system = hadoop_path(self.spark, f"{self.folder(tier, start)}/_SUCCESS")
        return system.exists(path)

    def cover(self, last: int) -> list[tuple[int, int]]:
        """The (tier, start) of committed folders that hold the batches 0 to ``last``, each once."""
        found, start = [], 0
        while start <= last:
            tier = 0
            while start % self.fan ** (tier + 1) == 0 and start + self.fan ** (tier + 1) <= last + 1:
                tier += 1
            found += self.held(tier, start)
            start += self.fan**tier
        return found

    def held(self, tier: int, start: int) -> list[tuple[int, int]]:
        if self.committed(tier, start):
            return [(tier, start)]
        if tier == 0:
            return []
        width = self.fan ** (tier - 1)
        return [f for i in range(self.fan) for f in self.held(tier - 1, start + i * width)]

    def load(self, folders: list[tuple[int, int]], buckets: list[int] | None = None) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema).select(*self.columns)
        reader = self.spark.read.schema(self.schema).option("basePath", self.path)
        rows = reader.parquet(*[self.folder(*f) for f in folders])
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(buckets))
        return rows.select(*self.columns)

    def read(self, last: int, buckets: list[int] | None = None) -> DataFrame:
        """The rows of the batches up to ``last``, not merged over folders."""
        return self.load(self.cover(last), buckets)

    def save(self, rows: DataFrame, tier: int, start: int) -> None:
        dealt = rows.select(*self.columns).withColumn("bucket", bucket_of(self.key, self.buckets))
        # A large bucket is dealt to several tasks, so few buckets do not bound the tasks that write.
        dealt.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(self.folder(tier, start))

    def append(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Write a batch, and the merged folders that it completes; returns its rows as written."""
        self.save(rows, 0, batch_id)
        tier = 1
        while (batch_id + 1) % self.fan**tier == 0:
            start = batch_id + 1 - self.fan**tier
            self.save(self.merge(self.load(self.parts(tier, start))), tier, start)
            tier += 1
        self.sweep(batch_id - self.fan)
        return self.load([(0, batch_id)])

    def parts(self, tier: int, start: int) -> list[tuple[int, int]]:
        width = self.fan ** (tier - 1)
        return [f for i in range(self.fan) for f in self.held(tier - 1, start + i * width)]

    def sweep(self, batch_id: int) -> None:
        """Remove the parts of the folders that ``batch_id`` merged."""
        tier = 1
        while batch_id >= 0 and (batch_id + 1) % self.fan**tier == 0:
            start = batch_id + 1 - self.fan**tier
            if self.committed(tier, start):
                for i in range(self.fan):
                    path, system = hadoop_path(self.spark, self.folder(tier - 1, start + i * self.fan ** (tier - 1)))
                    system.delete(path, True)
            tier += 1

    def last(self) -> int:
        """The newest batch that is there; -1 without any."""
        path, system = hadoop_path(self.spark, f"{self.path}/tier=*/start=*/_SUCCESS")
        ends = [-1]
        for status in system.globStatus(path) or []:
            folder = status.getPath().getParent()
            start = int(folder.getName().split("=")[1])
            tier = int(folder.getParent().getName().split("=")[1])
            ends.append(start + self.fan**tier - 1)
        return max(ends)

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of the rows' keys: at most ``buckets`` numbers."""
        found = rows.select(bucket_of(self.key, self.buckets).alias("b")).distinct().collect()
        return sorted(r["b"] for r in found)


def newest(rows: DataFrame, keys: list[str], version: str = "version") -> DataFrame:
    """The row of the highest version of each key."""
    others = [c for c in rows.columns if c not in keys]
    held = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), version).alias("row"))
    return held.select(*keys, "row.*").select(*rows.columns)
