"""Position signals that hold their last decision until a new one is made."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.operators.ordered import Layout, hand_over

SIGNAL, ACTION = "model_prediction", "strategy_action"


def signal(df: DataFrame, k, t: str, on: Column, off: Column, width: int | None = None,
           laid: Layout | None = None) -> DataFrame:
    """1 from a row where ``on`` holds, 0 from one where ``off`` holds, else as on the row before.

    ``on`` is asked first; a condition that is NULL does not hold.  The action is
    the preceding row's signal, both start at 0.
    """
    decided = F.when(on, 1).when(off, 0)
    return hand_over(df, k, t, decided, SIGNAL, start=F.lit(0), shifted=ACTION, width=width, laid=laid)


# The thresholds of the three rules.

def hybrid_rule(p: str = "p", price: str = "close_price", mean: str = "SMA_50") -> tuple[Column, Column]:
    """Buy above 0.45; leave below 0.25 unless the price is above its mean."""
    above = F.coalesce(F.col(price) > F.col(mean), F.lit(False))
    return F.col(p) > 0.45, (F.col(p) < 0.25) & ~above


def trend_rule(p: str = "p", price: str = "close_price", mean: str = "SMA_50") -> tuple[Column, Column]:
    """In while the price is above its mean; otherwise buy above 0.45, leave below 0.40."""
    return (F.col(price) > F.col(mean)) | (F.col(p) > 0.45), F.col(p) < 0.40


def macd_rule(p: str = "p", line: str = "MACD", smoothed: str = "Signal_Line",
              strength: str = "RSI") -> tuple[Column, Column]:
    """Buy on an upward trend the model backs (0.40); leave on a downward one or above strength 80."""
    up, down = F.col(line) > F.col(smoothed), F.col(line) < F.col(smoothed)
    return up & (F.col(p) > 0.40), down | (F.col(strength) > 80)
