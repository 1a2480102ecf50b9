import datetime as dt

import pytest
from pyspark.sql import functions as F

from ridgeline.operators import trips as tr
from ridgeline.plans import trip_report

ZONES = [(1, "North", "A"), (2, "North", "B"), (3, "South", "B"), (4, "South", "C")]


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame(ZONES, "LocationID int, Borough string, Zone string").withColumn("extra", F.lit("x"))


def trip(n, pu, do, hour, stay, distance, total):
    start = dt.datetime(2021, 3, 1, hour, 30) if hour is not None else None
    return (n, pu, do, start, start and start + dt.timedelta(hours=stay), distance, total, total / 10, total / 2, 1.0)


@pytest.fixture(scope="module")
def trips(spark):
    rows = [trip(i, 1, 2, 8, 1, 2.0, 10.0) for i in range(5)]
    rows += [trip(10 + i, 1, 4, 8, 0, 3.0, 20.0 + i) for i in range(6)]
    rows += [trip(20 + i, 3, 1, 9, 3, 1.0, 99.0) for i in range(4)]
    rows += [trip(30, 2, 1, 9, 3, 1.0, 98.0), trip(31, 99, 1, 23, 2, 9.0, 5.0), trip(32, 2, 2, None, 0, 9.0, 7.0)]
    return spark.createDataFrame(rows, """n int, PULocationID int, DOLocationID int, lpep_pickup_datetime timestamp,
        lpep_dropoff_datetime timestamp, trip_distance double, total_amount double, tip_amount double,
        fare_amount double, tolls_amount double""")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_roles_keep_unmatched_trips_and_name_no_column_twice(trips, zones):
    out = tr.enrich_roles(trips, zones)
    assert out.count() == trips.count() and len(set(out.columns)) == len(out.columns)
    assert rows(out.filter("n = 31").select("Pickup_Zone", "Dropoff_Zone", "Dropoff_Borough")) == [(None, "A", "North")]


def test_counting_by_number_first_equals_joining_first(trips, zones):
    early = tr.zone_counts(trips, zones, tr.ROLES, measure="total_amount")
    late = tr.enrich_roles(trips, zones).groupBy("Pickup_Zone", "Dropoff_Zone").agg(
        F.count(F.lit(1)).alias("trip_count"), F.avg("total_amount").alias("avg_cost"))
    assert sorted(rows(early), key=str) == sorted(rows(late), key=str)
    assert ("B", "A", 5, 98.8) in rows(early)  # zones 2 and 3 share a name


def test_a_route_needs_more_than_five_trips(trips, zones):
    assert rows(trip_report.most_expensive_route(trips, zones)) == [("A", "C", 6, 22.5)]


def test_busiest_zones_break_ties_by_name(trips, zones):
    assert rows(trip_report.busiest_zones(trips, zones, 1)) == [("A", 11)]
    assert rows(trip_report.busiest_zones(trips, zones, 5)) == [("A", 11), ("B", 6), (None, 1)]
    level = trips.filter("n in (10, 20, 31)")
    assert rows(trip_report.busiest_zones(level, zones, 2)) == [("A", 1), ("B", 1)]


def test_longest_trip(trips, zones):
    got = trip_report.longest_trip(trips, zones, "n", ["trip_distance", "total_amount"])
    assert rows(got) == [(None, "A", 9.0, 5.0)]


def test_hours(trips, zones):
    timed = tr.canonical_times(trips)
    top = tr.top_per_hour(timed, zones, "pickup_ts", "Pickup")
    assert rows(top) == [(8, "A", 11, 1), (9, "B", 5, 1), (23, None, 1, 1)]
    top = tr.top_per_hour(timed, zones, "dropoff_ts", "Dropoff")
    assert rows(top) == [(1, "A", 1, 1), (8, "C", 6, 1), (9, "B", 5, 1), (12, "A", 5, 1)]
    # the trip without a time makes no hour of its own
    assert rows(tr.hourly_in_out(timed)) == [(1, 0, 1), (8, 11, 6), (9, 5, 5), (12, 0, 5), (23, 1, 0)]


def test_time_families(trips):
    assert tr.canonical_times(trips).columns[3:5] == ["pickup_ts", "dropoff_ts"]
    renamed = trips.withColumnsRenamed({"lpep_pickup_datetime": "tpep_pickup_datetime",
                                        "lpep_dropoff_datetime": "tpep_dropoff_datetime"})
    assert tr.canonical_times(renamed).columns[3:5] == ["pickup_ts", "dropoff_ts"]
    with pytest.raises(ValueError):
        tr.canonical_times(trips.drop("lpep_pickup_datetime"))


def test_tip_correlation_has_no_value_for_a_constant(trips):
    got = dict(rows(tr.corr_with(trips, "tip_amount", ["total_amount", "tolls_amount"])))
    assert got["total_amount"] == pytest.approx(1.0) and got["tolls_amount"] is None


def test_report_and_statistics(trips, zones):
    report = trip_report.trip_report(trips, zones, "n")
    assert len(report) == 9
    total = report["trip_stats"].first()
    assert (total.Total_Trips, total.Max_Trip_Distance) == (18, 9.0)
    assert all(df.count() > 0 for df in report.values())


def test_zone_join_runs_after_the_counting(trips, zones):
    plan = tr.zone_counts(trips, zones, {"Pickup": "PULocationID"})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Join") < plan.rindex("Aggregate")


def test_report_equals_the_single_questions(trips, zones, tmp_path, spark):
    """All answers from one aggregate are those of the questions asked one by one; the trips are read twice."""
    path = str(tmp_path / "trips")
    trips.write.parquet(path)
    read = spark.read.parquet(path)
    report = trip_report.trip_report(read, zones, "n")
    timed = tr.canonical_times(trips)
    single = {
        "trip_stats": tr.summary(timed, trip_report.statistics()), "most_expensive_route": trip_report.most_expensive_route(timed, zones),
        "busiest_zone": trip_report.busiest_zones(timed, zones, 1), "top5_zones": trip_report.busiest_zones(timed, zones, 5),
        "longest_trip": trip_report.longest_trip(timed, zones, "n", ["trip_distance", "total_amount"]),
        "top_zone_per_hour": tr.top_per_hour(timed, zones, "pickup_ts", "Pickup"),
        "top_dropoff_zone_per_hour": tr.top_per_hour(timed, zones, "dropoff_ts", "Dropoff"), "busiest_hours": tr.hourly_in_out(timed),
        "tip_correlation": tr.corr_with(timed, "tip_amount", trip_report.FARES)}
    assert set(report) == set(single)
    for name, want in single.items():
        got, want = rows(report[name]), rows(want)
        assert len(got) == len(want), name
        for a, b in zip(got, want):
            assert [x if not isinstance(x, float) else pytest.approx(x, abs=1e-9) for x in b] == list(a), name
    of_trips = [name for name, df in report.items() if "dropoff_datetime" in df._jdf.queryExecution().analyzed().toString() or "tip_amount" in
                df._jdf.queryExecution().analyzed().toString()]
    assert [n for n in of_trips if n != "tip_correlation"] == ["longest_trip"]
