import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.operators import clean as cl
from ridgeline.plans import price_etl
from ridgeline.sources import files, jdbc

DAY = dt.date(2024, 1, 2)


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def wide(spark):
    return spark.createDataFrame(
        [("2024-01-02", 1.0, 2.0, 10.0, 5.0, None), ("2024-01-03", 1.5, float("nan"), None, 6.0, 7.0)],
        "Date string, A__Open double, A__Close double, A__Volume double, B__Open double, B__Close double")


def test_wide_to_long_and_normalized_prices(wide):
    long = price_etl.long_bars(wide, ["A", "B", "C"], ["Open", "High", "Low", "Close", "Volume"])
    assert long.count() == 4 and long.columns == ["Date", "ticker", "Open", "High", "Low", "Close", "Volume"]
    table = price_etl.price_table([long], clean=False)
    assert [(f.name, f.dataType.simpleString()) for f in table.schema] == [
        ("date", "date"), ("open_price", "double"), ("high_price", "double"), ("low_price", "double"),
        ("close_price", "double"), ("adj_close", "double"), ("volume", "bigint"), ("ticker", "string")]
    got = {(r.ticker, r.date.day): r for r in table.collect()}
    assert got["A", 2].close_price == 2.0 and got["A", 2].adj_close == 2.0 and got["A", 2].volume == 10
    assert got["A", 3].close_price == 0.0 and got["A", 3].volume == 0  # NaN and NULL both become 0
    assert got["B", 2].close_price == 0.0 and got["B", 3].adj_close == 7.0


def test_adjusted_close_of_one_frame_leaves_zero_in_the_others(spark):
    a = spark.createDataFrame([("2024-01-02", 1.0, 1.0, 1.0, 1.0, 0.9, 5, "A")],
                              "Date string, Open double, High double, Low double, Close double, `Adj Close` double, Volume long, ticker string")
    b = a.drop("Adj Close").withColumn("ticker", F.lit("B"))
    got = {r.ticker: r.adj_close for r in price_etl.price_table([a, b]).collect()}
    assert got == {"A": 0.9, "B": 0.0}
    assert price_etl.price_table([]).columns == price_etl.price_table([a]).columns and not price_etl.price_table([]).count()
    no_volume = a.drop("Volume")
    assert price_etl.price_table([no_volume], clean=False).first().volume == 0


@pytest.fixture(scope="module")
def bars(spark):
    return spark.createDataFrame(
        [("A", DAY, 1.0, 5), ("A", DAY + dt.timedelta(1), 2.0, 0), ("A", DAY + dt.timedelta(2), 0.0, 0),
         ("^X", DAY, 3.0, 0), ("^X", DAY + dt.timedelta(1), 0.0, 9), ("F=F", DAY, 4.0, 0)],
        "ticker string, date date, close_price double, volume long")


def test_cleaning_and_audits(bars):
    assert sorted(rows(cl.clean_bars(bars).select("ticker", "close_price"))) == [("A", 1.0), ("^X", 3.0)]
    assert rows(cl.clean_report(bars)) == [(6, 2, 4)]
    assert rows(cl.zero_audit(bars)) == [(4, 1)]
    assert sorted(rows(cl.zero_audit_by(bars, "ticker"))) == [("A", 2), ("F=F", 1), ("^X", 1)]


def test_range_and_membership(bars):
    assert cl.between(bars, "date", "2024-01-02", "2024-01-03").count() == 3
    assert cl.in_list(bars, "ticker", ["A", "zzz"]).count() == 3
    many = ["A", *[f"k{i}" for i in range(2000)]]
    assert cl.in_list(bars, "ticker", many).count() == 3
    assert sorted(rows(cl.missing_keys(bars, "ticker", ["A", "G", "H", "G"]))) == [("G",), ("H",)]


def test_missing_values(spark):
    df = spark.createDataFrame([(1.0, "x"), (math.nan, None), (None, "y")], "v double, s string")
    assert dict(rows(cl.null_counts(df))) == {"v": 2, "s": 1}
    assert cl.drop_missing(df).count() == 1 and cl.drop_missing(df, ["s"]).count() == 2
    assert [tuple(r) for r in cl.profile(df).select("column", "type", "rows", "present").collect()] == [
        ("v", "double", 3, 1), ("s", "string", 3, 2)]


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, i int")
    c = spark.createDataFrame([(3,)], "i int")
    assert sorted(rows(cl.union_all([a, b, c])), key=str) == [(1, "x"), (2, "y"), (3, None)]


def test_csv_by_header_name(spark, tmp_path):
    (tmp_path / "zones.csv").write_text('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark, Airport","E"\n2,Queens,,x\n')
    got = files.read_csv(spark, str(tmp_path / "zones.csv"), files.ZONES)
    assert rows(got) == [(1, "EWR", "Newark, Airport"), (2, "Queens", None)]
    with pytest.raises(ValueError):
        files.read_csv(spark, str(tmp_path / "zones.csv"), T.StructType([T.StructField("nope", T.StringType())]))
    with pytest.raises(Exception):
        files.read_parquet(spark, str(tmp_path / "absent.parquet")).count()
    # A second file with its columns in another order is refused, not read by position.
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_text("LocationID,Borough,Zone\n1,EWR,Newark\n")
    (folder / "b.csv").write_text("LocationID,Zone,Borough\n2,Astoria,Queens\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, str(folder), files.ZONES).collect()


def test_results_replace_what_was_there(spark, tmp_path):
    path = str(tmp_path / "results")
    files.write_results(spark.range(5), path)
    files.write_results(spark.range(2).withColumn("k", F.lit("a")), path, "k")
    assert files.read_parquet(spark, path).count() == 2


def test_a_failing_write_leaves_the_results_as_they_were(spark, tmp_path):
    path = str(tmp_path / "results")
    files.write_results(spark.range(5), path)
    broken = spark.range(9).select(F.when(F.col("id") == 7, F.raise_error(F.lit("stopped"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stopped"):
        files.write_results(broken, path)
    assert sorted(r.id for r in files.read_parquet(spark, path).collect()) == list(range(5))
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["results"]


@pytest.mark.parametrize("new_is_there", [False, True])
def test_a_swap_cut_short_is_finished(spark, tmp_path, new_is_there):
    """A job that ended between the two renames, or before the old table was deleted."""
    path, old = str(tmp_path / "results"), str(tmp_path / "results.old")
    spark.range(5).write.parquet(old)
    if new_is_there:
        spark.range(3).write.parquet(path)
    files.recover(spark, path)
    assert files.read_parquet(spark, path).count() == (3 if new_is_there else 5) and not files.exists(spark, old)
    files.write_results(spark.range(2), path)
    assert files.read_parquet(spark, path).count() == 2 and not files.exists(spark, old)


def test_a_range_reads_only_its_files_and_row_groups(spark, tmp_path):
    """Ten keys over twelve years: the scan of some months of two keys gives little more than their rows."""
    path = str(tmp_path / "prices")
    days = spark.range(4000).select(F.date_add(F.lit("2010-01-01").cast("date"), F.col("id").cast("int")).alias("date"), "id")
    keys = spark.range(10).select(F.concat(F.lit("k"), "id").alias("ticker"))
    rows = days.crossJoin(keys).repartition(5)
    files.write_ranged(rows.unionByName(rows.limit(1).withColumn("date", F.lit(None).cast("date"))), path, "ticker", "date", rows_per_file=2000, rows_per_group=100)
    assert spark.read.parquet(path).count() == 40_001

    def scanned(df):
        got = df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        plan = plan.finalPhysicalPlan() if "Adaptive" in plan.nodeName() else plan
        scan = plan.collectLeaves().head()
        return got, scan.metrics().apply("numOutputRows").value(), scan.metrics().apply("numFiles").value()

    lo, hi = "2014-03-01", "2014-06-01"
    got, read, opened = scanned(files.read_range(spark, path, "date", lo, hi, "ticker", ["k3", "k7"]))
    want = rows.filter((F.col("date") >= F.lit(lo)) & (F.col("date") < F.lit(hi)) & F.col("ticker").isin("k3", "k7"))
    assert len(got) == want.count() == 184 and read <= 1000 and opened < 10  # of 40,000 rows, 3,650 of them of that year
    got, read, _ = scanned(files.read_range(spark, path, "date", "2014-12-31", "2015-01-01"))
    assert len(got) == 10 and read < 3650
    got, read, opened = scanned(files.read_range(spark, path, "date", "2009-01-01", "2010-01-01"))
    assert not got and not read and not opened


class Recorder:
    """Stands in for a writer or reader and keeps what it was told; no database is opened."""

    def __init__(self):
        self.told, self.done = {}, None

    def format(self, kind):
        return self.option("format", kind)

    def option(self, name, value):
        self.told[name] = value
        return self

    def options(self, **given):
        self.told.update(given)
        return self

    def mode(self, name):
        return self.option("mode", name)

    def save(self):
        self.done = "saved"

    def load(self):
        return self


def test_jdbc_options():
    link = jdbc.connection("jdbc:x:y", "some.Driver", "me", None)
    assert link == {"url": "jdbc:x:y", "driver": "some.Driver", "user": "me"}
    frame = type("Frame", (), {"write": Recorder()})()
    jdbc.write_jdbc(frame, "prices", link, partitions=4)
    assert frame.write.done == "saved" and frame.write.told == {
        "format": "jdbc", **link, "dbtable": "prices", "numPartitions": 4, "mode": "overwrite"}
    session = type("Session", (), {"read": Recorder()})()
    told = jdbc.read_jdbc(session, "prices", link, "date", "2014-01-01", "2026-01-01", 12).told
    assert told["partitionColumn"] == "date" and told["numPartitions"] == 12
    with pytest.raises(ValueError):
        jdbc.read_jdbc(session, "prices", link, partition_column="date")
