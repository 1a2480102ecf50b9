"""The given tables seen as zones, trips, fares and daily bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.operators.clean import clean_bars, is_index

# Series keys and period limits of the given orders.
TICKERS = ["S1", "S2", "S3", "^I4", "^I5"]
PERIODS = [("train", None, "1999-01-01"), ("test", "1999-01-01", "2000-01-01"),
           ("validation", "2000-01-01", "2001-01-01"), ("prediction", "2001-01-01", None)]
PREDICT_FROM = "2001-01-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def zones(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("LocationID"), F.col("r_name").alias("Borough"), F.col("n_name").alias("Zone"))


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """Events as trips: the value is the distance, and the duration in minutes."""
    return table(spark, folder, "events").select(
        "event_id", "event_type",
        F.col("ts").alias("tpep_pickup_datetime"),
        F.expr("timestampadd(SECOND, cast(round(value * 60) as int), ts)").alias("tpep_dropoff_datetime"),
        F.expr("cast(user_id % 25 as int)").alias("PULocationID"),
        F.expr("cast(event_id % 25 as int)").alias("DOLocationID"),
        F.col("value").alias("trip_distance"))


def fares(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as fares, one dataset per line status."""
    price = F.col("l_extendedprice")
    return table(spark, folder, "lineitem").select(
        F.col("l_linestatus").alias("dataset"),
        F.col("l_quantity").alias("trip_distance"), price.alias("fare_amount"),
        (price * F.col("l_discount")).alias("tip_amount"), (price * F.col("l_tax")).alias("tolls_amount"),
        (price * (1 + F.col("l_discount") + F.col("l_tax"))).alias("total_amount"))


def bars(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as daily bars, one series per order priority."""
    digit = F.substring("o_orderpriority", 1, 1)
    price = F.col("o_totalprice")

    def scaled(c: Column) -> Column:
        return 100 + c / 10_000
    return (
        table(spark, folder, "orders")
        .select(F.concat(F.when(digit.isin("4", "5"), "^I").otherwise("S"), digit).alias("ticker"),
                F.to_date("o_orderdate").alias("date"), "o_orderkey", price)
        .groupBy("ticker", "date")
        .agg(scaled(F.min_by(price, "o_orderkey")).alias("open_price"),
             scaled(F.max(price)).alias("high_price"), scaled(F.min(price)).alias("low_price"),
             scaled(F.max_by(price, "o_orderkey")).alias("close_price"),
             (F.count(F.lit(1)) - 1).alias("volume"))
    )


def gap_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Every key on every date; NULL measures where the key has no bar."""
    days = bars(spark, folder)
    grid = days.select("date").distinct().select(
        "date", F.explode(F.array(*[F.lit(k) for k in TICKERS])).alias("ticker"))
    return grid.join(days, ["ticker", "date"], "left").select(
        "date", "open_price", "high_price", "low_price", "close_price",
        F.col("close_price").alias("adj_close"), "volume", "ticker")


def raw_bars(spark: SparkSession, folder: str) -> DataFrame:
    return gap_bars(spark, folder).na.fill(0)


def prices(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaned price table.

    Cleaning removes exactly the bars that filling gaps with 0 makes up and the
    idle ones, so it is applied to the bars there are.
    """
    return clean_bars(bars(spark, folder)).select(
        "date", "open_price", "high_price", "low_price", "close_price",
        F.col("close_price").alias("adj_close"), "volume", "ticker")


def chance(t: str = "date", k: str = "ticker") -> Column:
    """A repeatable stand-in for a model's probability."""
    days = F.datediff(F.col(t), F.lit("1995-01-01").cast("date")).cast("long")
    digit = F.substring(k, -1, 1).cast("long")
    return ((days * 7919 + digit * 104729) % 1000).cast("double") / F.lit(1000.0)


def category(k: str = "ticker") -> Column:
    return F.when(is_index(k), "INDICES").otherwise("STOCKS")


def labels(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as a scored two-class table with many tied scores."""
    return table(spark, folder, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        F.col("l_discount").alias("score"),
        F.when(F.col("l_discount") >= 0.05, 1).otherwise(0).alias("pred"))
