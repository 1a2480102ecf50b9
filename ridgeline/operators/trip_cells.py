"""All questions of a trip table from one aggregate.

A cell holds the trips of one pickup zone, drop-off zone, pickup hour and drop-off hour: counts, sums and what
correlations need. Every count of routes, zones and hours is a sum over cells, so the trips are read once.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions.columns import missing
from ridgeline.operators.trips import ROLES, enrich_roles, first_per_hour, per_hour
from ridgeline.session import settle

HOURS = {"pickup_ts": "_in", "dropoff_ts": "_out"}


def _pair(df: DataFrame, x: str, y: str) -> Column:
    return ~missing(df, x) & ~missing(df, y)


def _moments(df: DataFrame, x: str, y: str) -> list[Column]:
    """Of the rows that have both: how many, sums, squares, products, and the range of each column."""
    both = _pair(df, x, y)
    a, b = (F.when(both, F.col(c).cast("double")) for c in (x, y))
    found = {"n": F.count(a), "sx": F.sum(a), "sy": F.sum(b), "sxx": F.sum(a * a), "syy": F.sum(b * b), "sxy": F.sum(a * b),
             "lx": F.min(a), "hx": F.max(a), "ly": F.min(b), "hy": F.max(b)}
    return [c.alias(f"_{y}_{name}") for name, c in found.items()]


def cells(trips: DataFrame, measures: list[str], target: str | None = None, with_target: list[str] = ()) -> DataFrame:
    """The stored cells of a trip table with ``pickup_ts`` and ``dropoff_ts``: one read of the trips."""
    hours = {out: F.hour(ts) for ts, out in HOURS.items()}
    sums = list(chain.from_iterable([F.sum(m).alias(f"_sum_{m}"), F.count(m).alias(f"_count_{m}"), F.max(m).alias(f"_max_{m}")] for m in measures))
    moments = list(chain.from_iterable(_moments(trips, target, c) for c in with_target))
    return settle(trips.withColumns(hours).groupBy(*ROLES.values(), *HOURS.values()).agg(F.count(F.lit(1)).alias("_n"), *sums, *moments))


def summary(found: DataFrame, aggs: dict[str, tuple[str, str | None]]) -> DataFrame:
    """Named figures of the whole table: ``("count", None)``, ``("avg", measure)`` or ``("max", measure)``."""
    def figure(kind: str, m: str | None) -> Column:
        if kind == "count":
            return F.coalesce(F.sum("_n"), F.lit(0))
        return F.max(f"_max_{m}") if kind == "max" else F.try_divide(F.sum(f"_sum_{m}"), F.sum(f"_count_{m}"))
    return found.agg(*[figure(*what).alias(name) for name, what in aggs.items()])


def zone_counts(found: DataFrame, zones: DataFrame, roles: dict[str, str], by=(), measure: str | None = None) -> DataFrame:
    """As ``trips.zone_counts``, from cells."""
    kept = ["_n", *([f"_sum_{measure}", f"_count_{measure}"] if measure else [])]
    by_number = found.groupBy(*by, *roles.values()).agg(*[F.sum(c).alias(c) for c in kept])
    whole = [F.sum("_n").alias("trip_count")]
    if measure:
        whole.append(F.try_divide(F.sum(f"_sum_{measure}"), F.sum(f"_count_{measure}")).alias("avg_cost"))
    named = enrich_roles(by_number, zones, roles, attrs=("Zone",))
    return named.groupBy(*by, *[f"{role}_Zone" for role in roles]).agg(*whole)


def busiest_per_hour(found: DataFrame, zones: DataFrame, ts: str, role: str, n: int = 1) -> DataFrame:
    """As ``trips.top_per_hour``, from cells."""
    at = found.withColumn("hr", F.col(HOURS[ts])).filter("hr IS NOT NULL")
    return first_per_hour(zone_counts(at, zones, {role: ROLES[role]}, by=["hr"]), role, n)


def hours(found: DataFrame) -> DataFrame:
    """As ``trips.hourly_in_out``, from cells."""
    return per_hour(found.select(F.inline(F.array(
        F.struct(F.col("_in").alias("hr"), F.col("_n").alias("start"), F.lit(0).cast("long").alias("end")),
        F.struct(F.col("_out").alias("hr"), F.lit(0).cast("long").alias("start"), F.col("_n").alias("end"))))))


def corr_with(found: DataFrame, cols: list[str]) -> DataFrame:
    """As ``trips.corr_with``, from the cells' moments; NULL where a column has one value only."""
    def corr(y: str) -> Column:
        s = {name: F.sum(f"_{y}_{name}") for name in ("n", "sx", "sy", "sxx", "syy", "sxy")}
        spread = (F.max(f"_{y}_hx") > F.min(f"_{y}_lx")) & (F.max(f"_{y}_hy") > F.min(f"_{y}_ly"))
        cov = s["sxy"] - F.try_divide(s["sx"] * s["sy"], s["n"])
        of_x, of_y = s["sxx"] - F.try_divide(s["sx"] * s["sx"], s["n"]), s["syy"] - F.try_divide(s["sy"] * s["sy"], s["n"])
        return F.when(spread & (of_x > 0) & (of_y > 0), cov / F.sqrt(of_x * of_y))
    return found.agg(*[corr(c).alias(c) for c in cols]).unpivot([], cols, "column", "correlation")
