"""Vendor frames to the cleaned price table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ridgeline.operators.clean import STAGING, clean_bars, normalize_bars, union_all, wide_to_long

FIELDS = ["Open", "High", "Low", "Close", "Adj Close", "Volume"]


def long_bars(wide: DataFrame, keys: list[str], fields: list[str] = FIELDS, t: str = "Date",
              sep: str = "__") -> DataFrame:
    """A vendor's wide frame as one row per key and date."""
    return wide_to_long(wide, t, keys, fields, sep=sep)


def price_table(frames: list[DataFrame], clean: bool = True) -> DataFrame:
    """Any number of long vendor frames as one price table; none give an empty one."""
    if not frames:
        frames = [SparkSession.active().createDataFrame([], STAGING)]
    table = normalize_bars(union_all(frames))
    return clean_bars(table) if clean else table
