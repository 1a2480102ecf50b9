"""Small helpers of the operators."""

from __future__ import annotations

import pickle
import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ridgeline.session import shared_dir

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the folder that driver and executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings that hold inside the block only."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def sent(spark: SparkSession, value):
    """A broadcast of ``value`` with its class, for workers that have no copy of this package; see ``received``.

    A plain broadcast of an object names its class only. For models of bounded size.
    """
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(shared):
    """The value of a broadcast made by ``sent``, built anew in each task that asks."""
    return pickle.loads(shared.value)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def placed(df: DataFrame, group: list[str], cell: str, order: list[Column], value: str | None = None) -> DataFrame:
    """Add ``place`` (1-based rank in the group) and, with ``value``, ``before`` (sum of the earlier rows' values).

    ``cell`` is a whole-number column that rises with ``order``. Rows are ranked inside a
    (group, cell) and the cells' totals are added up in a second, far smaller step, so a
    group that holds most rows is still spread over as many tasks as it has cells. A global
    order is an empty ``group``. ``df`` is evaluated twice.
    """
    inner = W.partitionBy(*group, cell).orderBy(*order)
    rows = df.withColumn("place", F.row_number().over(inner))
    if value:
        running = inner.rowsBetween(W.unboundedPreceding, W.currentRow)
        rows = rows.withColumn("before", F.sum(value).over(running) - F.col(value))
    totals = df.groupBy(*group, cell).agg(
        F.count(F.lit(1)).alias("_n"), *([F.sum(value).alias("_v")] if value else []))
    earlier = W.partitionBy(*group).orderBy(cell).rowsBetween(W.unboundedPreceding, W.currentRow)
    totals = totals.select(*group, cell, (F.sum("_n").over(earlier) - F.col("_n")).alias("_n0"),
                           *([(F.sum("_v").over(earlier) - F.col("_v")).alias("_v0")] if value else []))
    a, b = rows.alias("a"), totals.alias("b")
    both = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*group, cell]])
    out = a.join(b, both, "left").select("a.*", "b._n0", *(["b._v0"] if value else []))
    out = out.withColumn("place", F.col("place") + F.col("_n0")).drop("_n0")
    return out.withColumn("before", F.col("before") + F.col("_v0")).drop("_v0") if value else out


def shuffle_order(seed: str, *names: str) -> Column:
    """32 hex digits that put rows in a seeded order; the same in every engine that has md5."""
    parts = [F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names]
    return F.md5(F.concat_ws(":", F.lit(seed), *parts))


def cell_of(order: Column, digits: int = 3) -> Column:
    """The first hex digits of ``shuffle_order`` as a number: 16 ** digits cells of equal size."""
    return F.conv(F.substring(order, 1, digits), 16, 10).cast("int")
