"""Database tables over Spark's JDBC source.  Connection data always comes from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def connection(url: str, driver: str, user: str | None = None, password: str | None = None) -> dict[str, str]:
    given = {"url": url, "driver": driver, "user": user, "password": password}
    return {name: value for name, value in given.items() if value is not None}


def write_jdbc(df: DataFrame, table: str, options: dict[str, str], partitions: int | None = None) -> None:
    """Replace ``table``; ``partitions`` bounds the number of parallel connections."""
    writer = df.write.format("jdbc").options(**options).option("dbtable", table)
    if partitions:
        writer = writer.option("numPartitions", partitions)
    writer.mode("overwrite").save()


def read_jdbc(spark: SparkSession, table: str, options: dict[str, str], partition_column: str | None = None,
              lower: str | None = None, upper: str | None = None, partitions: int | None = None) -> DataFrame:
    """The whole table; with a partition column, read by that many queries in parallel.

    ``lower`` and ``upper`` only set the stride, rows outside them are read too.
    """
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    split = {"partitionColumn": partition_column, "lowerBound": lower, "upperBound": upper,
             "numPartitions": partitions}
    if any(v is not None for v in split.values()):
        absent = [name for name, v in split.items() if v is None]
        if absent:
            raise ValueError(f"a parallel read also needs {absent}")
        reader = reader.options(**split)
    return reader.load()
