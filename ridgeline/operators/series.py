"""Per-key operators on a price series: key ``k``, time ``t``, value ``x``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ridgeline.functions import indicators as ind
from ridgeline.functions.columns import names
from ridgeline.operators.ordered import ROWS, attach, over_series


def pct_change(df: DataFrame, k, t: str, x: str, out: str = "Daily_Return", **layout) -> DataFrame:
    """Relative change against the preceding row; NULL on the first row and after a zero."""
    return over_series(df, k, t, 1, lambda d, w: d.withColumn(out, ind.change_ratio(x, w)), **layout)


def lags(df: DataFrame, k, t: str, x: str, offsets=(1, 2, 5), **layout) -> DataFrame:
    """``Lag_<n>`` for each offset, and ``Price_Change`` against the preceding row."""
    def step(d, w):
        shifted = {f"Lag_{n}": F.lag(x, n).over(w) for n in offsets}
        return d.withColumns({**shifted, "Price_Change": F.col(x) - F.lag(x).over(w)})
    return over_series(df, k, t, max(1, *offsets), step, **layout)


def label_up(df: DataFrame, k, t: str, x: str, **layout) -> DataFrame:
    """``Next_Close``, and ``Target`` = 1 where it is higher than this row's value.

    The last row of a key has no next value; its label is 0.
    """
    def step(d, w):
        up = F.when(F.lead(x).over(w) > F.col(x), 1).otherwise(0)
        return d.withColumns({"Next_Close": F.lead(x).over(w), "Target": up})
    return over_series(df, k, t, 0, step, ahead=True, **layout)


def sma(df: DataFrame, k, t: str, x: str, n, **layout) -> DataFrame:
    """``SMA_<n>`` over the last ``n`` rows (one length or several), NULL until there are ``n``."""
    lengths = [n] if isinstance(n, int) else list(n)
    return over_series(df, k, t, max(lengths), lambda d, w: ind.averages(d, w, x, lengths), **layout)


def bollinger(df: DataFrame, k, t: str, x: str, n: int = 20, m: float = 2.0, **layout) -> DataFrame:
    return over_series(df, k, t, n, lambda d, w: ind.bands(d, w, x, n, m), **layout)


def rsi(df: DataFrame, k, t: str, x: str, n: int = 14, **layout) -> DataFrame:
    return over_series(df, k, t, n, lambda d, w: ind.averages(d, w, x, [], n), **layout)


def with_gaps(df: DataFrame, k, t: str, x: str, spans: list[int], finish: Callable[[DataFrame], DataFrame],
              step: Callable[[DataFrame, WindowSpec], DataFrame] | None = None, before: int = 1, ahead: bool = False,
              **layout) -> DataFrame:
    """``over_series`` for exponential means: ``finish`` finds ``_gap_<span>``, the price less its mean, in each row.

    Parts get as many earlier rows as the means remember, and have several times as many of
    their own.  A missing ``x`` stops the job that reads a mean.
    """
    keys, back = names(k), ind.look_back(spans)
    layout.setdefault("rows", max(ROWS, 4 * back))

    def whole(d: DataFrame, w: WindowSpec) -> DataFrame:
        return finish(ind.gaps(step(d, w) if step else d, keys, t, w, x, spans))
    return over_series(df, keys, t, max(before, back), whole, ahead, **layout)


def ema(df: DataFrame, k, t: str, x: str, span, **layout) -> DataFrame:
    """``EMA_<span>`` (one span or several), seeded with the first value.  A missing ``x`` raises."""
    spans = [span] if isinstance(span, int) else list(span)
    means = {f"EMA_{s}": F.col(x) - F.col(f"_gap_{s}") for s in spans}
    return with_gaps(df, k, t, x, spans, lambda d: d.withColumns(means), **layout)


def macd(df: DataFrame, k, t: str, x: str, fast: int = 12, slow: int = 26, smooth: int = 9, **layout) -> DataFrame:
    return with_gaps(df, k, t, x, [fast, slow, smooth], lambda d: ind.trend(d, x, fast, slow, smooth), **layout)


def sma_cross(df: DataFrame, k, t: str, x: str, short: int = 50, long: int = 200,
              skip_warmup: bool = False, **layout) -> DataFrame:
    """Rows where the short mean crosses the long one: ``golden`` upwards, ``death`` downwards.

    While the long mean is undefined the position counts as level, so the first
    defined row is an event too unless ``skip_warmup`` is set.
    """
    crossed = (F.col("_side") != 0) & (F.col("_was").isNull() | (F.col("_side") != F.col("_was")))
    if skip_warmup:
        crossed &= F.col("_had").isNotNull()

    def step(d, w):
        d = ind.averages(d, w, x, [short, long])
        d = d.withColumn("_diff", F.col(f"SMA_{short}") - F.col(f"SMA_{long}"))
        d = d.withColumn("_side", F.coalesce(F.signum("_diff"), F.lit(0.0)))
        d = d.withColumns({"_was": F.lag("_side").over(w), "_had": F.lag("_diff").over(w)})
        return d.filter(crossed).withColumn("event", F.when(F.col("_side") > 0, "golden").otherwise("death"))
    return over_series(df, k, t, long, step, **layout).select(*names(k), t, x, "event")


def last_n(df: DataFrame, k, t: str, n: int) -> DataFrame:
    """The latest ``n`` rows of each key; each task keeps at most ``n`` per key before the shuffle."""
    newest = Window.partitionBy(*names(k)).orderBy(F.desc(t))
    return df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= n).drop("_rank")


def rebase(df: DataFrame, k, t: str, x: str, base: float = 100_000.0, out: str = "normalized") -> DataFrame:
    """The series scaled so that each key starts at ``base``."""
    keys = names(k)
    start = df.groupBy(*keys).agg(F.min_by(x, t).alias("_start"))
    return attach(df, start, keys).withColumn(out, F.try_divide(F.col(x), F.col("_start")) * base).drop("_start")
