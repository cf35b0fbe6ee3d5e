"""Serving tables in a database. The driver jar comes with the cluster.

A load goes to a staging table first, in parallel; then one transaction on the driver replaces
the keys that it holds. So a second load of the same rows changes nothing, and a load that fails
leaves the table as it was.
"""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


def plain(name: str) -> str:
    """A table or column name, as it goes into statements; anything else is an error."""
    if not all(part.isidentifier() for part in name.split(".")):
        raise ValueError(f"not a plain name: {name!r}")
    return name


def staging_name(table: str, load: str) -> str:
    return plain(f"{table}_load_{load}")


def replace_statements(table: str, staged: str, key: str, columns: list[str]) -> list[str]:
    """The statements of the transaction: rows of staged keys go, the staged rows come."""
    names = ", ".join(plain(c) for c in columns)
    return [
        f"delete from {plain(table)} where {plain(key)} in (select {key} from {plain(staged)})",
        f"insert into {table} ({names}) select {names} from {staged}",
    ]


def bounds_query(table: str, column: str) -> str:
    """The least and greatest value of a column as a one-row table."""
    return f"(select min({plain(column)}) as lo, max({column}) as hi from {plain(table)}) bounds"


def range_options(column: str, bounds: tuple | None, splits: int) -> dict[str, str]:
    """Options of a read in ``splits`` ranges between the table's own bounds; none for a table
    without values, and no more ranges than values."""
    if bounds is None or bounds[0] is None:
        return {}
    low, high = int(bounds[0]), int(bounds[1])
    splits = max(1, min(splits, high - low + 1))
    # Spark leaves the last range open, so rows at the upper bound are read as well.
    return {
        "partitionColumn": plain(column), "lowerBound": str(low), "upperBound": str(high + 1), "numPartitions": str(splits),
    }


@dataclass(frozen=True)
class Database:
    """``options``: driver, user, password and whatever else the driver takes."""

    url: str
    options: dict[str, str] = field(default_factory=dict)

    def reader(self, spark: SparkSession, table: str, **more: str):
        return spark.read.format("jdbc").options(url=self.url, dbtable=table, **self.options, **more)

    def bounds(self, spark: SparkSession, table: str, column: str) -> tuple | None:
        row = self.reader(spark, bounds_query(table, column)).load().first()
        return row and (row["lo"], row["hi"])

    def read(self, spark: SparkSession, table: str, split_on: str | None = None, splits: int = 8) -> DataFrame:
        """A table, in parallel ranges of a whole-numbered column when one is named."""
        more = range_options(split_on, self.bounds(spark, table, split_on), splits) if split_on else {}
        return self.reader(spark, table, **more).load()

    def run(self, spark: SparkSession, statements: list[str]) -> None:
        """All statements in one transaction."""
        jvm = spark.sparkContext._jvm
        properties = jvm.java.util.Properties()
        for name, value in self.options.items():
            properties.setProperty(name, value)
        if "driver" in self.options:
            jvm.java.lang.Class.forName(self.options["driver"])
        connection = jvm.java.sql.DriverManager.getConnection(self.url, properties)
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            for text in statements:
                statement.execute(text)
            connection.commit()
        finally:
            connection.close()

    def stage(self, rows: DataFrame, staged: str) -> None:
        rows.write.format("jdbc").options(url=self.url, dbtable=staged, **self.options).mode("overwrite").save()

    def replace(self, rows: DataFrame, table: str, key: str, load: str) -> None:
        """Put ``rows``, one per key, in the place of the table's rows of these keys."""
        staged = staging_name(table, load)
        self.stage(rows, staged)
        self.run(rows.sparkSession, replace_statements(table, staged, key, rows.columns))
        self.run(rows.sparkSession, [f"drop table {staged}"])
