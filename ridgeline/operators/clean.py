"""Ingestion shaping, cleaning and audits of daily bars."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.functions.columns import missing, names

# The staging schema and the renamed price columns.
STAGING = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("adj_close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("ticker", T.StringType()),
])
PRICE_NAMES = {"open": "open_price", "high": "high_price", "low": "low_price", "close": "close_price"}


def wide_to_long(df: DataFrame, t: str, keys: list[str], fields: list[str], key: str = "ticker",
                 sep: str = "__") -> DataFrame:
    """One row per time and key from columns named ``<key><sep><field>``.

    A key without any column is left out (see ``missing_keys``); an absent field
    of a present key is NULL.
    """
    present = [k for k in keys if any(f"{k}{sep}{f}" in df.columns for f in fields)]
    kinds = {f: next((df.schema[f"{k}{sep}{f}"].dataType for k in present if f"{k}{sep}{f}" in df.columns),
                     T.DoubleType()) for f in fields}

    def field(k: str, f: str) -> Column:
        name = f"{k}{sep}{f}"
        return (F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast(kinds[f]).alias(f)

    blocks = [F.struct(F.lit(k).alias(key), *[field(k, f) for f in fields]) for k in present]
    return df.select(t, F.inline(F.array(*blocks)))


def missing_keys(df: DataFrame, k: str, wanted: list[str]) -> DataFrame:
    """Wanted keys that have no row."""
    spark = df.sparkSession
    asked = spark.createDataFrame([(w,) for w in dict.fromkeys(wanted)], T.StructType([df.schema[k]]))
    return asked.join(df.select(k).distinct(), k, "left_anti")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Concatenate by column name; a column some frames lack is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def plain_names(df: DataFrame) -> DataFrame:
    """Column names in lower case with underscores for spaces."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def normalize_bars(df: DataFrame) -> DataFrame:
    """Vendor frame (any naming, some columns absent, values missing) to the price table.

    A missing value becomes 0, which makes bars without a price; ``clean_bars`` removes
    them.  An adjusted close is taken from the close only when
    the whole frame has no such column.
    """
    df = plain_names(df)
    if "adj_close" not in df.columns:
        df = df.withColumn("adj_close", F.col("close"))
    if "volume" not in df.columns:
        df = df.withColumn("volume", F.lit(0))
    numbers = [f.name for f in STAGING if f.name not in ("date", "ticker")]
    filled = df.select(*STAGING.names).na.fill(0, numbers)
    typed = filled.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STAGING])
    return (
        typed.withColumn("date", F.to_date("date", "yyyy-MM-dd"))
        .withColumnsRenamed(PRICE_NAMES)
    )


def between(df: DataFrame, t: str, lo: str, hi: str) -> DataFrame:
    """Rows of ``[lo, hi)``."""
    low, high = (F.lit(dt.date.fromisoformat(d)) for d in (lo, hi))
    return df.filter((F.col(t) >= low) & (F.col(t) < high))


def in_list(df: DataFrame, k: str, values: list) -> DataFrame:
    """Rows whose ``k`` is among ``values``."""
    return df.filter(F.col(k).isin(values))


def is_index(k: str = "ticker") -> Column:
    return F.col(k).startswith("^")


def is_sound(k: str = "ticker", close: str = "close_price", volume: str = "volume") -> Column:
    """A traded bar: positive close, and some volume unless it is an index."""
    return (F.col(close) > 0) & ~(~is_index(k) & (F.col(volume) == 0))


def clean_bars(df: DataFrame, k: str = "ticker") -> DataFrame:
    return df.filter(is_sound(k))


def clean_report(df: DataFrame, k: str = "ticker") -> DataFrame:
    """Rows before and after ``clean_bars`` and rows dropped, from one scan."""
    kept = F.count_if(is_sound(k))
    total = F.count(F.lit(1))
    return df.agg(total.alias("rows_before"), kept.alias("rows_after"), (total - kept).alias("rows_dropped"))


def drop_missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows with a NULL or NaN in any of ``cols`` (all by default)."""
    return df.na.drop("any", subset=cols)


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, from one scan."""
    counts = df.agg(*[F.count_if(missing(df, c)).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "missing")


def zero_audit(df: DataFrame, volume: str = "volume", close: str = "close_price") -> DataFrame:
    """Rows without volume, and those of them without a price as well."""
    idle = F.col(volume) == 0
    return df.agg(F.count_if(idle).alias("zero_volume"),
                  F.count_if(idle & (F.col(close) == 0)).alias("zero_volume_and_price"))


def zero_audit_by(df: DataFrame, by, volume: str = "volume") -> DataFrame:
    """Rows without volume per key, only keys that have some."""
    return df.filter(F.col(volume) == 0).groupBy(*names(by)).agg(F.count(F.lit(1)).alias("zero_volume"))


def profile(df: DataFrame) -> DataFrame:
    """Position, name, type and present values of every column, with the row and column count."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"),
                    *[F.count(F.when(~missing(df, f.name), 1)).alias(f"n{i}") for i, f in enumerate(df.schema)])
    lines = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                      F.lit(f.dataType.simpleString()).alias("type"), F.col(f"n{i}").alias("present"))
             for i, f in enumerate(df.schema)]
    return counts.select("rows", F.lit(len(df.columns)).alias("columns"), F.inline(F.array(*lines)))


def head(df: DataFrame, order: list, n: int = 5) -> DataFrame:
    """First ``n`` rows in an explicit order."""
    return df.orderBy(*order).limit(n)
