"""The feature table, its chronological split and the re-seeded slice."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.functions import indicators as ind
from ridgeline.operators.clean import drop_missing
from ridgeline.operators.ordered import over_series
from ridgeline.operators.series import with_gaps

# Columns that are not model inputs, those a slice may compute anew, and the period limits.
NOT_INPUTS = ["date", "ticker", "Target", "Next_Close", "adj_close"]
RESEEDED = ("SMA_50", "RSI", "MACD")
PERIODS = [("train", None, "2020-01-01"), ("test", "2020-01-01", "2023-01-01"),
           ("validation", "2023-01-01", "2024-01-01"), ("prediction", "2024-01-01", None)]


def features(df: DataFrame, k: str = "ticker", t: str = "date", x: str = "close_price",
             complete: bool = True, **layout) -> DataFrame:
    """All technical features and the next-day label, in one pass over each part.

    ``complete`` drops rows with any missing value: the 49 warm-up rows and the
    last row of each key, and rows whose strength index is undefined.
    """
    def step(d, w):
        # Everything over the plain time order first, so that it shares one sort.
        d = d.withColumns({
            "Daily_Return": ind.change_ratio(x, w),
            "Lag_1": F.lag(x, 1).over(w),
            "Lag_2": F.lag(x, 2).over(w),
            "Lag_5": F.lag(x, 5).over(w),
            "Price_Change": F.col(x) - F.lag(x, 1).over(w),
            "Month": F.month(t),
            "DayOfWeek": F.weekday(t),
            "Next_Close": F.lead(x).over(w),
            "Target": F.when(F.lead(x).over(w) > F.col(x), 1).otherwise(0),
        })
        d = ind.bands(ind.steps(d, w, x), w, x, 20, 2.0)
        return ind.averages(d, w, x, [10, 50], strength=14)

    table = with_gaps(df, k, t, x, [12, 26, 9], lambda d: ind.trend(d, x, 12, 26, 9, means=True), step,
                      before=50, ahead=True, **layout)
    raw = [c for c in df.columns if c != "Daily_Return"]
    table = table.select(
        *raw, "Daily_Return", "SMA_10", "SMA_50", "RSI", "EMA_12", "EMA_26", "MACD", "MACD_Signal",
        "Bollinger_Middle", "Bollinger_Std", "Bollinger_Upper", "Bollinger_Lower",
        "Lag_1", "Lag_2", "Lag_5", "Price_Change", "Month", "DayOfWeek", "Next_Close", "Target")
    # Where the 50-row mean is known so are the shorter windows and the lags, and exponential means are never missing:
    # they need not be computed to find the rows.
    return drop_missing(table, [*raw, "Daily_Return", "SMA_50", "RSI", "Next_Close"]) if complete else table


def input_columns(df: DataFrame, exclude=NOT_INPUTS) -> list[str]:
    """Model inputs: every column but the excluded ones."""
    return [c for c in df.columns if c not in exclude]


def date_split(df: DataFrame, t: str, periods=PERIODS, out: str = "split") -> DataFrame:
    """Name the half-open period ``[low, high)`` of each row; NULL outside all of them."""
    label = None
    for name, low, high in periods:
        inside = F.lit(True)
        if low is not None:
            inside &= F.col(t) >= F.lit(dt.date.fromisoformat(low))
        if high is not None:
            inside &= F.col(t) < F.lit(dt.date.fromisoformat(high))
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return df.withColumn(out, label)


def period(df: DataFrame, t: str, lo: str, hi: str | None = None) -> DataFrame:
    """Rows of ``[lo, hi]``."""
    rows = df.filter(F.col(t) >= F.lit(dt.date.fromisoformat(lo)))
    return rows if hi is None else rows.filter(F.col(t) <= F.lit(dt.date.fromisoformat(hi)))


def slice_indicators(df: DataFrame, lo: str, hi: str | None = None, k: str = "ticker", t: str = "date",
                     x: str = "close_price", reseed=RESEEDED, **layout) -> DataFrame:
    """Rows of ``[lo, hi]`` with the columns the position rules read.

    The columns named by ``reseed`` start afresh at the first row of the slice: the
    50-row mean, whose first 49 rows take its first value, the strength index, and
    the exponential means (``MACD``).  Others stay as computed on the whole series.
    The index is 50 where undefined.
    """
    unknown = set(reseed) - set(RESEEDED)
    if unknown:
        raise ValueError(f"no column to start afresh: {sorted(unknown)}")
    rows = period(df, t, lo, hi)
    mean, strength = "SMA_50" in reseed, "RSI" in reseed

    def step(d, w):
        d = ind.averages(ind.steps(d, w, x), w, x, [50] if mean else [], 14 if strength else None) if mean or strength else d
        if not mean:
            return d
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        first = F.first("SMA_50", ignorenulls=True).over(whole)
        return d.withColumn("SMA_50", F.when(F.col("_row") < 49, first).otherwise(F.col("SMA_50")))

    kept = rows.drop(*reseed, "Signal_Line")
    if "MACD" in reseed:
        out = with_gaps(kept, k, t, x, [12, 26, 9], lambda d: ind.trend(d, x, 12, 26, 9, signal="Signal_Line"), step,
                        before=50, **layout)
    else:
        out = (over_series(kept, k, t, 50, step, **layout) if reseed else kept).withColumn("Signal_Line", F.col("MACD_Signal"))
    return out.withColumn("RSI", F.coalesce("RSI", F.lit(50.0)))
