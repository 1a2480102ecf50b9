"""Profiles, pivots, correlation matrices and densities."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.functions.columns import cell_bounds, cell_in, missing, names, time_place, value_bucket
from ridgeline.operators.ordered import attach
from ridgeline.operators.series import pct_change
from ridgeline.session import settle


def _value_buckets(df: DataFrame, keys: list[str], x: str) -> tuple[DataFrame, DataFrame]:
    """The values as ``_x`` with their bucket, and the stored table of buckets: count, mean, spread, range.

    Missing values are a bucket without a number, in which nothing is counted.
    """
    rows = df.select(*keys, F.when(~missing(df, x), F.col(x).cast("double")).alias("_x"))
    rows = rows.withColumn("_bucket", F.when(F.col("_x").isNotNull(), value_bucket(F.col("_x"), 16_384)))
    return rows, settle(rows.groupBy(*keys, "_bucket").agg(
        F.count("_x").alias("_n"), F.avg("_x").alias("_mean"), (F.var_pop("_x") * F.count("_x")).alias("_off"), *cell_bounds("_x")))


def _quantiles(rows: DataFrame, counts: DataFrame, keys: list[str], shares: list[float]) -> DataFrame:
    """``order_statistics`` from the bucket table: reads the rows once more, for the buckets that hold a rank."""
    ranks = F.array(*[F.struct(F.lit(q).alias("share"), (F.lit(q) * (F.col("_total") - 1)).alias("at"))
                      for q in shares])

    def wanted(pieces: DataFrame, group: list[str], by: str) -> DataFrame:
        """The counted pieces that hold a rank, with the rank at which each begins."""
        upto = Window.partitionBy(*group).orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
        start = F.col("_start") + F.sum("_n").over(upto) - F.col("_n")
        return pieces.withColumn("_start", start).withColumn("_wanted", F.filter("_wanted", lambda r: (
            F.ceil(r["at"]) >= F.col("_start")) & (F.floor(r["at"]) < F.col("_start") + F.col("_n")))).filter(F.size("_wanted") > 0)

    counts = counts.filter("_n > 0").withColumn("_total", F.sum("_n").over(Window.partitionBy(*keys))).select(
        *keys, "_bucket", "_n", "_low", "_high", "_cells", F.lit(0).cast("long").alias("_start"), ranks.alias("_wanted"))
    buckets = settle(wanted(counts, keys, "_bucket"))
    # The stored buckets have a known size: a short table is sent to all tasks, by Spark's own limit.
    place = [*keys, "_bucket", "_cell"]
    held = rows.join(buckets.drop("_n"), [*keys, "_bucket"]).withColumn("_cell", cell_in(F.col("_x")))
    # Equal values are one row from here on; what is stored is read twice, the input no more.
    held = settle(held.groupBy(*place, "_x").agg(F.count(F.lit(1)).alias("_m"), F.first("_start").alias("_start"),
                                                 F.first("_wanted").alias("_wanted")))
    cells = wanted(
        held.groupBy(*place).agg(F.sum("_m").alias("_n"), F.first("_start").alias("_start"), F.first("_wanted").alias("_wanted")),
        [*keys, "_bucket"], "_cell")
    inside = Window.partitionBy(*place).orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    values = (
        held.select(*place, "_x", "_m").join(settle(cells), place)
        .withColumn("_upto", F.col("_start") + F.sum("_m").over(inside))
        .withColumn("_from", F.col("_upto") - F.col("_m"))
        .select(*keys, "_x", "_from", "_upto", F.inline("_wanted"))
    )

    def holds(rank):
        return (rank >= F.col("_from")) & (rank < F.col("_upto"))
    low, high = F.floor("at"), F.ceil("at")
    part = F.col("at") - low
    return (
        values.groupBy(*keys, "share", "at")
        .agg(F.max(F.when(holds(low), F.col("_x"))).alias("_low"),
             F.max(F.when(holds(high), F.col("_x"))).alias("_high"))
        .select(*keys, "share", (F.col("_low") + (F.col("_high") - F.col("_low")) * part).alias("value"))
    )


def order_statistics(df: DataFrame, k, x: str, shares: list[float]) -> DataFrame:
    """Exact quantiles per key with linear interpolation, as ``(key, share, value)``.

    Values are counted per key and value bucket first; the few buckets that hold a
    wanted rank are counted again in slices, as many as their rows call for, and
    only the slices that hold one are looked at value by value, so no task sees a
    whole key, however narrow its values lie.  Equal values are counted before
    anything is brought together.  The input is read twice.
    """
    keys = names(k)
    rows, counts = _value_buckets(df, keys, x)
    return _quantiles(rows, counts, keys, shares)


def describe_by(df: DataFrame, k, x: str) -> DataFrame:
    """count, mean, std, min, quartiles and max of the present values per key.

    Count, mean, spread and range follow from the same table of value buckets that leads to the
    quartiles, so the input is read twice.  A key without present values has a row with count 0.
    """
    keys = names(k)
    rows, buckets = _value_buckets(df, keys, x)
    n, whole = F.sum("_n"), Window.partitionBy(*keys)
    centred = buckets.withColumn("_centre", F.try_divide(F.sum(F.col("_n") * F.col("_mean")).over(whole), F.sum("_n").over(whole)))
    off = F.sum(F.col("_off") + F.col("_n") * (F.col("_mean") - F.col("_centre")) * (F.col("_mean") - F.col("_centre")))
    plain = centred.groupBy(*keys).agg(
        n.alias("count"), F.first("_centre").alias("mean"), F.when(n > 1, F.sqrt(F.try_divide(off, n - 1))).alias("std"),
        F.min("_low").alias("min"), F.max("_high").alias("max"))
    quartiles = {"p25": 0.25, "p50": 0.50, "p75": 0.75}
    spread = _quantiles(rows, buckets, keys, list(quartiles.values())).groupBy(*keys).agg(
        *[F.max(F.when(F.col("share") == q, F.col("value"))).alias(name) for name, q in quartiles.items()])
    return plain.join(spread, keys, "left").select(*keys, "count", "mean", "std", "min", *quartiles, "max")


def pivot_by(df: DataFrame, t: str, k: str, keys: list[str], x: str) -> DataFrame:
    """One row per time and one column per listed key holding the mean of ``x``."""
    return df.groupBy(t).pivot(k, keys).agg(F.avg(x))


def corr_matrix(df: DataFrame, k: str, t: str, x: str, keys: list[str], fill: str | None = None,
                ready: bool = False) -> DataFrame:
    """Correlation of every two listed keys' relative changes, as ``(key_a, key_b, corr, n)``.

    With ``ready`` the column is taken as it is, for a table that holds the changes already.

    ``fill="ffill"`` carries prices over gaps: on a time at which only other keys
    have a row, a key that has started has change 0.  Without, a pair uses the
    times at which both have a change.

    Keys are cut into blocks of ``TILE``.  A task has the rows of two blocks at some hundred times and adds
    them up into one matrix per moment, whatever the number of keys; the matrices are summed by pair.
    No pair is emitted per time, and a row is copied once per block of keys.
    """
    if fill not in (None, "ffill"):
        raise ValueError("fill is None or 'ffill'")
    if fill and ready:
        raise ValueError("only prices can be carried over gaps")
    listed = df.filter(F.col(k).isin(keys)).select(k, t, x)
    changes = listed.select(k, t, F.when(~missing(df, x), F.col(x)).cast("double").alias("change")) if ready else (
        pct_change(listed, k, t, x, out="change").select(k, t, "change"))
    number = F.array_position(F.array(*[F.lit(key) for key in keys]), F.col(k)).cast("int") - 1
    place = time_place(df, t)
    rows = changes.select(number.alias("key"), place.alias("t"), "change").filter("t IS NOT NULL")
    begun = later = None
    if fill:
        # The first time of every listed key, and how many times of the whole table come after it.
        found = dict(listed.groupBy(k).agg(F.min(place)).collect())
        begun = [found.get(key) for key in keys]
        later = _times_after(df.select(place.alias("t")).distinct(), begun)
    blocks = -(-len(keys) // TILE)
    own = F.floor(F.col("key") / TILE).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: F.struct(
        F.least(b, own).alias("p"), F.greatest(b, own).alias("q")))
    if isinstance(df.schema[t].dataType, T.DateType):
        cell = F.floor(F.col("t") / TILE_TIMES)  # no more days than that
    else:
        times = rows.agg(F.approx_count_distinct("t")).first()[0]
        cell = F.pmod(F.xxhash64("t"), F.lit(-(-max(times, 1) // TILE_TIMES)))
    units = rows.withColumn("cell", cell).select("key", "t", "change", "cell", F.inline(tiles))
    sums = units.groupBy("p", "q", "cell").applyInPandas(
        _tile_sums(TILE, len(keys), begun), "a int, b int, n double, sa double, sb double, saa double, sbb double, sab double")
    total = sums.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")])
    label = F.array(*[F.lit(key) for key in keys])
    n = F.col("n")
    if fill:
        after = F.array(*[F.lit(float(v)) for v in later])
        every = F.least(F.get(after, F.col("a")), F.get(after, F.col("b")))
        total = total.withColumn("n", every)
    cov = F.col("sab") - F.try_divide(F.col("sa") * F.col("sb"), n)
    var_a = F.col("saa") - F.try_divide(F.col("sa") * F.col("sa"), n)
    var_b = F.col("sbb") - F.try_divide(F.col("sb") * F.col("sb"), n)
    defined = (n > 1) & (var_a > 0) & (var_b > 0)
    return total.select(
        F.get(label, F.col("a")).alias("key_a"), F.get(label, F.col("b")).alias("key_b"),
        F.when(defined, cov / F.sqrt(var_a * var_b)).alias("corr"), n.cast("long").alias("n"))


# Keys of a block, and times that one task brings together.
TILE, TILE_TIMES = 128, 512


def _times_after(times: DataFrame, starts: list) -> list[int]:
    """How many of ``times`` lie after each start; 0 for a key without rows. Counted by the starts each time lies after."""
    known = {v: i for i, v in enumerate(sorted({v for v in starts if v is not None}))}
    if not known:
        return [0] * len(starts)
    passed = F.size(F.filter(F.array(*[F.lit(v) for v in known]), lambda v: v < F.col("t")))
    counts = dict(times.filter("t IS NOT NULL").groupBy(passed).count().collect())
    return [0 if v is None else sum(c for i, c in counts.items() if i > known[v]) for v in starts]


def _tile_sums(size: int, keys: int, begun: list | None):
    # Built here, not at module level, so that Spark ships the code itself and
    # the package need not be installed on the executors.
    def add_up(group, rows):
        p, q = int(group[0]), int(group[1])
        when, at = np.unique(rows["t"].to_numpy(), return_inverse=True)
        key, change = rows["key"].to_numpy(), rows["change"].to_numpy(float)

        def block(number):
            v = np.full((len(when), size), np.nan)
            mine = key // size == number
            # Of rows that repeat a key and time the largest change counts.
            np.fmax.at(v, (at[mine], key[mine] % size), change[mine])
            if begun:
                # A started key repeats its price where it has no row: its change there is 0.
                for i, start in enumerate(begun[number * size:(number + 1) * size]):
                    v[:, i] = np.nan if start is None else np.where(when > start, np.nan_to_num(v[:, i]), np.nan)
            return np.nan_to_num(v), (~np.isnan(v)).astype(float)

        x, in_x = block(p)
        y, in_y = (x, in_x) if p == q else block(q)
        parts = np.stack([in_x.T @ in_y, x.T @ in_y, in_x.T @ y, (x * x).T @ in_y, in_x.T @ (y * y), x.T @ y])
        # All pairs of the tile, so that those without a common time are in the result too.
        a, b = np.meshgrid(np.arange(size) + p * size, np.arange(size) + q * size, indexing="ij")
        keep = (a < b) & (b < keys)
        moments = dict(zip(("n", "sa", "sb", "saa", "sbb", "sab"), parts[:, keep]))
        return pd.DataFrame({"a": a[keep].astype(np.int32), "b": b[keep].astype(np.int32)} | moments)
    return add_up


def kde(df: DataFrame, k, x: str, lo: float = -0.10, hi: float = 0.10, points: int = 41) -> DataFrame:
    """Gaussian kernel density of ``x`` per key at evenly spaced points.

    The bandwidth is the sample deviation times n^(-1/5).  Every point is one
    aggregate with a map-side partial sum, so rows are never multiplied.  A key
    without spread has no bandwidth; its densities are NULL.
    """
    keys = names(k)
    rows = df.filter(~missing(df, x)).select(*keys, F.col(x).alias("_x"))
    band = F.stddev_samp("_x") * F.pow(F.count("_x").cast("double"), F.lit(-0.2))
    width = rows.groupBy(*keys).agg(F.count("_x").alias("_n"), band.alias("_h")).withColumn(
        "_h", F.when(F.col("_h") > 0, F.col("_h")))
    at = [lo + (hi - lo) * i / (points - 1) for i in range(points)]
    scaled = attach(rows, width, keys).select(*keys, "_h", "_n", (F.col("_x") / F.col("_h")).alias("_z"))

    def bump(g: float) -> Column:
        away = F.lit(g) / F.col("_h") - F.col("_z")
        return F.sum(F.exp(-0.5 * away * away))
    heights = scaled.groupBy(*keys, "_h", "_n").agg(*[bump(g).alias(f"_g{i}") for i, g in enumerate(at)])
    scale = F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi)
    lines = [F.struct(F.lit(i).alias("point"), F.lit(g).alias("x"), (F.col(f"_g{i}") / scale).alias("density"))
             for i, g in enumerate(at)]
    return heights.select(*keys, F.inline(F.array(*lines)))
