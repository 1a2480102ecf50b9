"""Questions on trip tables: routes, zones, hours and fares.

Zone attributes depend only on the zone number, so counts and sums are taken per
zone number first and joined to the zone table afterwards: the join then sees a
few rows per pair of zones instead of every trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.functions.columns import names, pearson

# The two naming families of the trip files.
TIME_FAMILIES = [("tpep_pickup_datetime", "tpep_dropoff_datetime"),
                 ("lpep_pickup_datetime", "lpep_dropoff_datetime")]
ROLES = {"Pickup": "PULocationID", "Dropoff": "DOLocationID"}


def canonical_times(df: DataFrame, families=TIME_FAMILIES) -> DataFrame:
    """Rename the time columns of whichever family is present to ``pickup_ts``, ``dropoff_ts``."""
    for start, end in families:
        if start in df.columns:
            return df.withColumnsRenamed({start: "pickup_ts", end: "dropoff_ts"})
    raise ValueError(f"none of the known time columns in {df.columns}")


def enrich_roles(fact: DataFrame, dim: DataFrame, roles: dict[str, str] = ROLES, key: str = "LocationID",
                 attrs=("Borough", "Zone")) -> DataFrame:
    """Left-join ``dim`` once per role; its attributes arrive as ``<role>_<attr>``.

    No broadcast hint: Spark broadcasts the dimension when its measured size
    allows and splits skewed partitions otherwise.
    """
    for role, column in roles.items():
        side = dim.select(F.col(key).alias(column), *[F.col(a).alias(f"{role}_{a}") for a in attrs])
        fact = fact.join(side, column, "left")
    return fact


def zone_counts(trips: DataFrame, zones: DataFrame, roles: dict[str, str], by=(),
                measure: str | None = None, attr: str = "Zone") -> DataFrame:
    """Trips per zone name of each role (and ``by``), with the mean of ``measure``."""
    parts = [F.count(F.lit(1)).alias("_n")]
    whole = [F.sum("_n").alias("trip_count")]
    if measure:
        parts += [F.sum(measure).alias("_sum"), F.count(measure).alias("_m")]
        whole.append(F.try_divide(F.sum("_sum"), F.sum("_m")).alias("avg_cost"))
    by_number = trips.groupBy(*by, *roles.values()).agg(*parts)
    named = enrich_roles(by_number, zones, roles, attrs=(attr,))
    return named.groupBy(*by, *[f"{role}_{attr}" for role in roles]).agg(*whole)


def summary(df: DataFrame, aggs: dict[str, Column], by: str | None = None) -> DataFrame:
    """Named aggregates of the whole table, or per value of ``by`` (e.g. a dataset name)."""
    grouped = df.groupBy(by) if by else df.groupBy()
    return grouped.agg(*[c.alias(name) for name, c in aggs.items()])


def top_groups(counts: DataFrame, keys, order: str = "trip_count", n: int = 1,
               more_than: int | None = None) -> DataFrame:
    """The ``n`` groups first by ``order``, ties by key; only groups of more than ``more_than`` trips."""
    if more_than is not None:
        counts = counts.filter(F.col("trip_count") > more_than)
    ties = [F.asc_nulls_last(c) for c in names(keys)]
    return counts.orderBy(F.desc_nulls_last(order), *ties).limit(n)


def top_rows(df: DataFrame, order: list[Column], n: int = 1) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_per_hour(trips: DataFrame, zones: DataFrame, ts: str, role: str, n: int = 1,
                   roles: dict[str, str] = ROLES) -> DataFrame:
    """The ``n`` busiest zones of each hour of the day.  Trips without a time count in no hour."""
    timed = trips.withColumn("hr", F.hour(ts)).filter("hr IS NOT NULL")
    return first_per_hour(zone_counts(timed, zones, {role: roles[role]}, by=["hr"]), role, n)


def first_per_hour(counts: DataFrame, role: str, n: int = 1) -> DataFrame:
    """The ``n`` rows of each ``hr`` with the most trips, ties by zone."""
    zone = f"{role}_Zone"
    busiest = Window.partitionBy("hr").orderBy(F.desc("trip_count"), F.asc_nulls_last(zone))
    return (
        counts.withColumn("rank", F.row_number().over(busiest)).filter(F.col("rank") <= n)
        .select("hr", zone, "trip_count", "rank").orderBy("hr", "rank")
    )


def visits(df: DataFrame, ts_in: str = "pickup_ts", ts_out: str = "dropoff_ts") -> DataFrame:
    """Every trip at its two hours: (hr, start, end)."""
    def visit(ts: str, starts: int) -> Column:
        return F.struct(F.hour(ts).alias("hr"), F.lit(starts).cast("long").alias("start"), F.lit(1 - starts).cast("long").alias("end"))
    return df.select(F.inline(F.array(visit(ts_in, 1), visit(ts_out, 0))))


def hourly_in_out(df: DataFrame, ts_in: str = "pickup_ts", ts_out: str = "dropoff_ts") -> DataFrame:
    """Pickups and drop-offs per hour of the day, 0 where there is none of one kind.

    Every trip is counted at its two hours in one scan, which equals the full
    outer join of the two hourly counts.  Missing times count nowhere.
    """
    return per_hour(visits(df, ts_in, ts_out))


def per_hour(visited: DataFrame) -> DataFrame:
    """Sums of ``start`` and ``end`` per ``hr``."""
    return (
        visited.filter("hr IS NOT NULL").groupBy("hr")
        .agg(F.sum("start").alias("pickup_count"), F.sum("end").alias("dropoff_count"))
        .orderBy("hr")
    )


def corr_with(df: DataFrame, target: str, cols: list[str]) -> DataFrame:
    """Correlation of ``target`` with each of ``cols``, all from one scan."""
    wide = df.agg(*[pearson(F.col(target), F.col(c)).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "correlation")
