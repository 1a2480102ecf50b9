"""Windowed columns of one price series.

Every function takes a frame whose rows are in pieces (see ``operators.ordered``),
the window over a piece and the price column, and returns the frame with columns
added.  A value that is not defined yet is NULL.  Helper columns start with an
underscore; ``over_series`` drops them at the end, so functions used together
share them.
"""

from __future__ import annotations

import math
import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

# Running sums divide by powers of the decay; within a block of rows these stay
# below e^400, so prices up to 1e130 do not overflow.
BLOCK_NATS = 400.0
# What is older than this adds less than e^-240 of its size and is left out.
FADED_NATS = 240.0
# Earlier blocks that a block may have to look at before spans get blocks of their own.
MOST_BEFORE = 4


def full_frame(aggregate: Column, x: str, n: int, w: WindowSpec) -> Column:
    """``aggregate`` over the last ``n`` rows, NULL until there are ``n`` values."""
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(x).over(frame) == n, aggregate.over(frame))


def change_ratio(x: str, w: WindowSpec) -> Column:
    return F.try_divide(F.col(x), F.lag(x).over(w)) - 1


def _piece(lengths: list[int]) -> int:
    """Length of the short sums that the wanted windows are put together from."""
    common = math.gcd(*lengths)
    fitting = [d for d in range(1, common + 1) if common % d == 0 and d * d <= 4 * max(lengths)]
    return fitting[-1]


# A window of more pieces than these is put together from sums that grow so many times in length, the first over so many rows.
MOST_PIECES, GROWTH, DIRECT = 20, 4, 8


def window_sums(df: DataFrame, w: WindowSpec, wanted: dict[str, tuple[str, int]]) -> DataFrame:
    """Add the sum of the last ``n`` values of ``x`` as each ``out: (x, n)``; NULL until there are ``n``.

    Spark adds up a sliding frame anew for every row.  A long window is therefore
    put together from sums over short ones, shifted: 50 rows are five sums of 10.
    Lengths without a fair common divisor take sums over 8, 32, 128, ... rows, each from
    four of the one before: 199 rows are 128, 32, 32 and 7.  Values are counted as the
    difference of two running counts.
    """
    lengths: dict[str, list[int]] = {}
    for x, n in wanted.values():
        lengths.setdefault(x, []).append(n)
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    first: dict[str, Column] = {f"_count_{x}": F.count(x).over(running) for x in lengths}
    levels: list[dict[str, Column]] = []
    pieces: dict[tuple[str, int], list[tuple[str, int]]] = {}

    def short(x: str, n: int) -> str:
        # A window of NULLs alone has no sum; such rows are left out by their count.
        first[f"_sum{n}_{x}"] = F.coalesce(F.sum(x).over(w.rowsBetween(-(n - 1), 0)), F.lit(0.0))
        return f"_sum{n}_{x}"

    for x, ns in lengths.items():
        size = _piece(ns)
        if max(ns) <= MOST_PIECES * size:
            name = short(x, size)
            pieces |= {(x, n): [(name, i) for i in range(0, n, size)] for n in ns}
            continue
        known = {DIRECT: short(x, DIRECT)}
        while GROWTH * max(known) <= max(ns):
            size, before = max(known), known[max(known)]
            name = known[GROWTH * size] = f"_sum{GROWTH * size}_{x}"
            depth = len(known) - 2
            levels += [{}] * (depth + 1 - len(levels))
            levels[depth] = levels[depth] | {name: reduce(operator.add, [F.col(before), *[F.lag(before, i * size, 0.0).over(w) for i in range(1, GROWTH)]])}
        for n in ns:
            parts, at = [], 0
            for size in sorted(known, reverse=True):
                while n - at >= size:
                    parts.append((known[size], at))
                    at += size
            if n > at:
                parts.append((short(x, n - at), at))
            pieces[x, n] = parts
    for added in [first, *levels]:
        df = df.withColumns(added)

    def total(x: str, n: int) -> Column:
        return reduce(operator.add, [F.lag(name, at).over(w) if at else F.col(name) for name, at in pieces[x, n]])

    def counted(x: str, n: int) -> Column:
        return F.col(f"_count_{x}") - F.coalesce(F.lag(f"_count_{x}", n).over(w), F.lit(0))
    return df.withColumns({out: F.when(counted(x, n) == n, total(x, n)) for out, (x, n) in wanted.items()})


def steps(df: DataFrame, w: WindowSpec, x: str) -> DataFrame:
    """Row number from 0, change against the preceding row (none on the first), and its two sides."""
    if "_step" in df.columns:
        return df
    change = F.coalesce(F.col(x) - F.lag(x).over(w), F.lit(0.0))
    return df.withColumns({
        "_row": F.row_number().over(w) - 1, "_step": F.when(F.col(x).isNotNull(), change),
    }).withColumns({
        "_up": F.greatest("_step", F.lit(0.0)), "_down": F.greatest(-F.col("_step"), F.lit(0.0)),
    })


def averages(df: DataFrame, w: WindowSpec, x: str, lengths: list[int], strength: int | None = None) -> DataFrame:
    """``SMA_<n>`` for each length and, over ``strength`` rows, ``RSI``; NULL until there are as many values.

    The relative strength compares the gains and losses of its rows.  The first
    row of a series counts as no change; rows without any change have no value,
    rows without a loss have 100.
    """
    wanted = {f"SMA_{n}": (x, n) for n in lengths}
    if strength:
        df = steps(df, w, x)
        wanted |= {"_gain": ("_up", strength), "_loss": ("_down", strength)}
    df = window_sums(df, w, wanted)
    added = {f"SMA_{n}": F.col(f"SMA_{n}") / n for n in lengths}
    if strength:
        gain, loss = F.col("_gain"), F.col("_loss")
        added["RSI"] = (
            F.when(loss > 0, 100 - 100 / (1 + F.try_divide(gain, loss)))
            .when(gain > 0, F.lit(100.0))
        )
    return df.withColumns(added)


def bands(df: DataFrame, w: WindowSpec, x: str, n: int = 20, m: float = 2.0) -> DataFrame:
    """Rolling mean and sample deviation, and the band of ``m`` deviations around it."""
    return df.withColumns({
        "Bollinger_Middle": full_frame(F.avg(x), x, n, w),
        "Bollinger_Std": full_frame(F.stddev_samp(x), x, n, w),
    }).withColumns({
        "Bollinger_Upper": F.col("Bollinger_Middle") + F.col("Bollinger_Std") * m,
        "Bollinger_Lower": F.col("Bollinger_Middle") - F.col("Bollinger_Std") * m,
    })


def decay(span: int) -> float:
    """Weight of the previous value in an exponential mean of this span."""
    return 1.0 - 2.0 / (span + 1.0)


def nats(span: int) -> float:
    """How far the weight of a value falls in one row, as a logarithm."""
    return -math.log(decay(span)) if decay(span) > 0 else BLOCK_NATS


def look_back(spans: list[int]) -> int:
    """Rows until the slowest of the means has forgotten a value."""
    return max(math.ceil(FADED_NATS / nats(s)) for s in spans)


def _groups(spans: list[int]) -> list[tuple[int, dict[int, int]]]:
    """(rows of a block, {span: earlier blocks it has to look at}): spans share blocks unless they are too far apart."""
    out, left = [], sorted(set(spans))
    while left:
        block = max(1, math.floor(BLOCK_NATS / nats(left[0])))
        before = {s: math.ceil(FADED_NATS / (block * nats(s))) for s in left}
        taken = {s: n for s, n in before.items() if n <= MOST_BEFORE or s == left[0]}
        out.append((block, taken))
        left = [s for s in left if s not in taken]
    return out


def gaps(df: DataFrame, k: list[str], t: str, w: WindowSpec, x: str, spans: list[int]) -> DataFrame:
    """Add ``_gap_<span>``, the price minus its exponential mean, on a part with ``look_back`` rows before its own.

    With q the weight of the past and d the row-to-row change, the gap is the sum
    of q^(i+1) times the change i rows ago.  That is zero on the first row and
    exactly zero on a constant series.  The sum runs as an ordinary running
    window inside blocks of rows; of the blocks before, the last sums are carried
    on as far as they are not yet forgotten.  All of it is columns, so a column
    that nobody reads is not computed.
    """
    absent = F.col(x).isNull() | F.isnan(F.col(x).cast("double"))
    df = steps(df, w, x).withColumn("_change", F.when(F.col("_home") & absent, F.raise_error(
        F.lit(f"an exponential mean needs every {x}"))).otherwise(F.coalesce("_step", F.lit(0.0))))
    for number, (block, before) in enumerate(_groups(spans)):
        b, place = f"_block{number}", F.pmod("_row", F.lit(block))
        df = df.withColumn(b, F.floor(F.col("_row") / block))
        inside = Window.partitionBy(*k, "_part", b).orderBy(t).rowsBetween(Window.unboundedPreceding, 0)
        # The same order as inside blocks, so the rows are not sorted again.
        onward = Window.partitionBy(*k, "_part").orderBy(b, t).rowsBetween(Window.unboundedPreceding, -1)
        power = {s: F.pow(F.lit(decay(s)), place + 1) for s in before}
        df = df.withColumns({f"_own_{s}": F.sum(F.col("_change") / F.pow(F.lit(decay(s)), place)).over(inside) * power[s] for s in before})
        for level in range(1, max(before.values()) + 1):
            # At the end of a block stands its own sum, then what the blocks before it had left there.
            seen = "_own_{}" if level == 1 else f"_end{level - 1}_{{}}"
            df = df.withColumns({f"_end{level}_{s}": F.coalesce(F.last(F.when(place == block - 1, F.col(seen.format(s))), ignorenulls=True).over(onward), F.lit(0.0))
                                 for s, n in before.items() if level <= n})
        total = {}
        for s, n in before.items():
            carried = F.lit(0.0)
            for level in range(n, 0, -1):
                carried = F.col(f"_end{level}_{s}") + carried * decay(s) ** block
            total[f"_gap_{s}"] = F.col(f"_own_{s}") + carried * power[s]
        df = df.withColumns(total)
    return df


def trend(df: DataFrame, x: str, fast: int = 12, slow: int = 26, smooth: int = 9, line: str = "MACD",
          signal: str = "MACD_Signal", means: bool = False) -> DataFrame:
    """From ``_gap_`` columns: difference of two exponential means and that difference's own exponential mean.

    An exponential mean of an exponential mean is a difference of two gaps scaled
    by a constant, so the smoothed line needs no second pass over the series.
    """
    if smooth in (fast, slow):
        raise ValueError("the smoothing span must differ from the two others")
    g = {s: F.col(f"_gap_{s}") for s in (fast, slow, smooth)}
    a = 1 - decay(smooth)

    def smoothed(span: int) -> Column:
        return (g[smooth] - g[span]) * (a * decay(span) / (decay(smooth) - decay(span)))

    added = {line: g[slow] - g[fast], signal: smoothed(slow) - smoothed(fast)}
    if means:
        added |= {f"EMA_{fast}": F.col(x) - g[fast], f"EMA_{slow}": F.col(x) - g[slow]}
    return df.withColumns(added)
