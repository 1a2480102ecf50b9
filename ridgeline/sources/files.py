"""File sources and sinks; a missing input raises instead of being skipped."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The zone table's columns the questions read.
ZONES = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, matched to ``schema`` by column name.

    With an explicit schema Spark needs no pass over the data to guess types.
    Columns of the file the schema does not name are left out.  All files of a
    folder must have the same header; one with other names or another order stops the read.
    """
    header = spark.read.option("header", True).csv(path).columns
    known = {f.name: f for f in schema}
    absent = [n for n in known if n not in header]
    if absent:
        raise ValueError(f"{path}: no column {absent}")
    full = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in header])
    checked = spark.read.schema(full).option("header", True).option("enforceSchema", False)
    # The header is compared over the columns that are read, so all of them are.
    return checked.option("columnPruning", False).csv(path).select(*known)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def _at(spark: SparkSession, path: str):
    """The path as Hadoop has it, and its file system."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there, there.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    there, system = _at(spark, path)
    return system.exists(there)


def move_new(spark: SparkSession, source: str, target: str) -> None:
    """Give a finished folder its name; if another has it by now, that one stays and this one goes."""
    (a, system), (b, _) = _at(spark, source), _at(spark, target)
    if system.exists(b) or not system.rename(a, b):
        system.delete(a, True)
        if not system.exists(b):
            raise OSError(f"{source} could not be moved to {target}")


def write_results(df: DataFrame, path: str, partition_by: str | None = None, options: dict | None = None) -> None:
    """Replace the results table at ``path``, or leave the one there as it is if that fails.

    The new table is written beside it and read back: only with as many rows as were written does it take
    the name. The old table is moved aside before and deleted after, so ``recover`` finds one of them
    whenever the job ends in between. Renames are single steps on HDFS and local disks; a store without
    them copies, so a reader of such a store may find no table for that time.
    """
    spark = df.sparkSession
    staged, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old"
    recover(spark, path)
    # The rows are counted by the tasks that write them, without another pass over the input.
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(partition_by)
    (new, system), (target, _), (aside, _) = _at(spark, staged), _at(spark, path), _at(spark, old)
    try:
        writer.parquet(staged)
        written, found = seen.get["n"], spark.read.schema(df.schema).parquet(staged).count()
        if written != found:
            raise OSError(f"{found} of {written} rows arrived in {staged}")
    except BaseException:
        system.delete(new, True)
        raise
    if system.exists(target) and not system.rename(target, aside):
        raise OSError(f"{path} could not be moved aside")
    if not system.rename(new, target):
        recover(spark, path)
        raise OSError(f"{staged} could not be moved to {path}")
    system.delete(aside, True)


def recover(spark: SparkSession, path: str) -> None:
    """After a ``write_results`` that was cut short: the old table gets its name back, or goes if the new one has it."""
    (target, system), (aside, _) = _at(spark, path), _at(spark, f"{path}.old")
    if system.exists(aside):
        if system.exists(target):
            system.delete(aside, True)
        elif not system.rename(aside, target):
            raise OSError(f"{path}.old could not be moved back")


PERIOD = "_period"


def write_ranged(df: DataFrame, path: str, k: str, t: str, rows_per_file: int = 5_000_000, rows_per_group: int = 100_000) -> None:
    """A series table from which a range of times is read without the rest: one folder per year of ``t``, rows by key and time.

    Files are ranges of (year, key, time) and sorted, so a row group holds one stretch of a key, and its least and
    greatest values tell whether it can be skipped. Rows without a time are in a folder of their own. Replaces what was there.
    """
    dated = df.withColumn(PERIOD, F.year(t))
    order = [PERIOD, k, t]
    laid = dated.repartitionByRange(*order).sortWithinPartitions(*order)
    write_results(laid, path, PERIOD, {"maxRecordsPerFile": rows_per_file, "parquet.block.row.count.limit": rows_per_group})


def read_range(spark: SparkSession, path: str, t: str, lo: str, hi: str, k: str | None = None, keys: list | None = None) -> DataFrame:
    """Rows of ``[lo, hi)`` of a table by ``write_ranged``, of the listed keys if any are named."""
    first, end = F.lit(lo).cast("date"), F.lit(hi).cast("date")
    # The last moment of the range is in the year before ``hi`` if that is a first of January.
    years = F.col(PERIOD).between(F.year(first), F.year(F.date_sub(end, 1)))
    found = spark.read.parquet(path).filter(years & (F.col(t) >= first) & (F.col(t) < end)).drop(PERIOD)
    return found if keys is None else found.filter(F.col(k).isin(keys))
