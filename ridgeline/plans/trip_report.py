"""The full set of questions on one trip table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.operators import trip_cells as tc
from ridgeline.operators import trips as tr


def statistics() -> dict:
    return {
        "Total_Trips": F.count(F.lit(1)),
        "Avg_Total_Amount": F.avg("total_amount"),
        "Avg_Trip_Distance": F.avg("trip_distance"),
        "Max_Trip_Distance": F.max("trip_distance"),
    }


def most_expensive_route(trips: DataFrame, zones: DataFrame, measure: str = "total_amount",
                         more_than: int = 5) -> DataFrame:
    routes = tr.zone_counts(trips, zones, tr.ROLES, measure=measure)
    return tr.top_groups(routes, ["Pickup_Zone", "Dropoff_Zone"], "avg_cost", 1, more_than)


def busiest_zones(trips: DataFrame, zones: DataFrame, n: int) -> DataFrame:
    counts = tr.zone_counts(trips, zones, {"Pickup": tr.ROLES["Pickup"]})
    return tr.top_groups(counts, "Pickup_Zone", n=n)


def longest_trip(trips: DataFrame, zones: DataFrame, tie: str, cols: list[str]) -> DataFrame:
    """Zones and ``cols`` of the longest trip; the one row is found before it is joined."""
    longest = tr.top_rows(trips, [F.desc_nulls_last("trip_distance"), F.asc(tie)])
    return tr.enrich_roles(longest, zones).select("Pickup_Zone", "Dropoff_Zone", *cols)


FARES = ["trip_distance", "fare_amount", "total_amount", "tolls_amount"]


def trip_report(trips: DataFrame, zones: DataFrame, tie: str) -> dict[str, DataFrame]:
    """Every question's answer for one trip table, as frames by name.

    The trips are read twice: once for the cells, from which all counts, means and correlations
    follow, and once for the longest trip.
    """
    trips = tr.canonical_times(trips)
    found = tc.cells(trips, ["total_amount", "trip_distance"], "tip_amount", FARES)
    return _from_cells(found, zones, "total_amount") | {
        "trip_stats": tc.summary(found, {
            "Total_Trips": ("count", None), "Avg_Total_Amount": ("avg", "total_amount"),
            "Avg_Trip_Distance": ("avg", "trip_distance"), "Max_Trip_Distance": ("max", "trip_distance")}),
        "longest_trip": longest_trip(trips, zones, tie, ["trip_distance", "total_amount"]),
        "tip_correlation": tc.corr_with(found, FARES),
    }


def _from_cells(found: DataFrame, zones: DataFrame, measure: str, more_than: int = 5) -> dict[str, DataFrame]:
    routes = tc.zone_counts(found, zones, tr.ROLES, measure=measure)
    pickups = tc.zone_counts(found, zones, {"Pickup": tr.ROLES["Pickup"]})
    return {
        "most_expensive_route": tr.top_groups(routes, ["Pickup_Zone", "Dropoff_Zone"], "avg_cost", 1, more_than),
        "busiest_zone": tr.top_groups(pickups, "Pickup_Zone", n=1),
        "top5_zones": tr.top_groups(pickups, "Pickup_Zone", n=5),
        "top_zone_per_hour": tc.busiest_per_hour(found, zones, "pickup_ts", "Pickup"),
        "top_dropoff_zone_per_hour": tc.busiest_per_hour(found, zones, "dropoff_ts", "Dropoff"),
        "busiest_hours": tc.hours(found),
    }


def long_report(trips: DataFrame, zones: DataFrame, tie: str, measure: str) -> DataFrame:
    """The answers of a table that has one measure, as one long table (question, hr, zone, other, n, value).

    ``n`` counts trips (drop-offs in ``other_n``), ``value`` is the mean or the single measure.
    """
    trips = tr.canonical_times(trips)
    found = tc.cells(trips, [measure])
    answers = _from_cells(found, zones, measure) | {"longest_trip": longest_trip(trips, zones, tie, [measure])}
    told = {"Pickup_Zone": "zone", "Dropoff_Zone": "other", "trip_count": "n", "avg_cost": "value", measure: "value",
            "pickup_count": "n", "dropoff_count": "other_n"}
    empty = trips.sparkSession.createDataFrame([], "hr int, zone string, other string, n long, other_n long, value double")
    out = empty.withColumn("question", F.lit(""))
    for name, df in answers.items():
        out = out.unionByName(df.drop("rank").withColumnsRenamed(told).withColumn("question", F.lit(name)), allowMissingColumns=True)
    return out
