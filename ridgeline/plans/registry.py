"""Every operator as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.functions import indicators as ind
from ridgeline.operators import clean as cl
from ridgeline.operators import features as ft
from ridgeline.operators import ledger as lg
from ridgeline.operators import metrics as mt
from ridgeline.operators import ordered as od
from ridgeline.operators import series as se
from ridgeline.operators import signals as sg
from ridgeline.operators import stats as st
from ridgeline.operators import trips as tr
from ridgeline.plans import backtest, price_etl, study, trip_report
from ridgeline.plans import fixtures as fx
from ridgeline.session import settle, shared_dir
from ridgeline.sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
KEY = ("ticker", "date", "close_price")
# Digits after the point that are compared: eight, but few enough to leave out the
# last bits of large amounts, and more for a mean whose own ninth digit is a 5.
DIGITS = 8
DIGITS_OF = {"portfolio_value": 2, "final_value": 2, "normalized": 4, "benchmark": 6, "SMA_200": 9}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(fn(spark, folder))
    QUERIES[fn.__name__] = run
    return fn


def comparable(df: DataFrame) -> DataFrame:
    """Doubles rounded, whole numbers to 64 bits, dates to text: one form in every engine."""
    def plain(f: T.StructField):
        if isinstance(f.dataType, T.DoubleType):
            return F.round(f.name, DIGITS_OF.get(f.name, DIGITS)).alias(f.name)
        if isinstance(f.dataType, T.IntegerType):
            return F.col(f.name).cast("long").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.col(f.name).cast("string").alias(f.name)
        return F.col(f.name)
    return df.select(*[plain(f) for f in df.schema])


# Trips

@query
def trip_stats(spark, folder):
    return tr.summary(fx.fares(spark, folder), trip_report.statistics(), by="dataset")


@query
def trips_with_zones(spark, folder):
    named = tr.enrich_roles(fx.trips(spark, folder), fx.zones(spark, folder))
    return named.select("event_id", "PULocationID", "DOLocationID", "Pickup_Borough", "Pickup_Zone",
                        "Dropoff_Borough", "Dropoff_Zone", "trip_distance")


@query
def most_expensive_route(spark, folder):
    return trip_report.most_expensive_route(fx.trips(spark, folder), fx.zones(spark, folder), "trip_distance")


@query
def busiest_zone(spark, folder):
    return trip_report.busiest_zones(fx.trips(spark, folder), fx.zones(spark, folder), 1)


@query
def top5_zones(spark, folder):
    return trip_report.busiest_zones(fx.trips(spark, folder), fx.zones(spark, folder), 5)


@query
def longest_trip(spark, folder):
    return trip_report.longest_trip(fx.trips(spark, folder), fx.zones(spark, folder), "event_id",
                                    ["trip_distance", "event_id"])


def _timed(spark, folder):
    return tr.canonical_times(fx.trips(spark, folder))


@query
def top_zone_per_hour(spark, folder):
    return tr.top_per_hour(_timed(spark, folder), fx.zones(spark, folder), "pickup_ts", "Pickup")


@query
def top_dropoff_zone_per_hour(spark, folder):
    return tr.top_per_hour(_timed(spark, folder), fx.zones(spark, folder), "dropoff_ts", "Dropoff")


@query
def busiest_hours(spark, folder):
    return tr.hourly_in_out(_timed(spark, folder))


@query
def tip_correlation(spark, folder):
    return tr.corr_with(fx.fares(spark, folder), "tip_amount",
                        ["trip_distance", "fare_amount", "total_amount", "tolls_amount"])


@query
def trip_answers(spark, folder):
    return trip_report.long_report(fx.trips(spark, folder), fx.zones(spark, folder), "event_id", "trip_distance")


# Ingestion and cleaning

@query
def src_csv_roundtrip(spark, folder):
    customer = fx.table(spark, folder, "customer")
    path = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    files.write_csv(customer, path)
    return files.read_csv(spark, path, customer.schema)


def _vendor_wide(spark, folder):
    """The bars as a vendor delivers them: one row per date, one column per key and field."""
    first = {"Open": "open_price", "High": "high_price", "Low": "low_price", "Close": "close_price",
             "Volume": "volume"}
    return (
        fx.bars(spark, folder).withColumnRenamed("date", "Date").groupBy("Date")
        .pivot("ticker", fx.TICKERS).agg(*[F.max(c).alias(name) for name, c in first.items()])
    )


def _vendor_long(spark, folder):
    return price_etl.long_bars(_vendor_wide(spark, folder), fx.TICKERS,
                               ["Open", "High", "Low", "Close", "Volume"], sep="_")


@query
def wide_to_long(spark, folder):
    return _vendor_long(spark, folder)


@query
def missing_keys(spark, folder):
    return cl.missing_keys(fx.bars(spark, folder), "ticker", [*fx.TICKERS, "S9", "^I0"])


@query
def union_by_name(spark, folder):
    days = fx.bars(spark, folder)
    frames = [days.filter(F.col("ticker") == k) for k in fx.TICKERS]
    frames[-1] = frames[-1].drop("volume")
    return cl.union_all(frames)


@query
def normalize_bars(spark, folder):
    return price_etl.price_table([_vendor_long(spark, folder)], clean=False)


@query
def bars_range(spark, folder):
    return cl.between(fx.prices(spark, folder), "date", "1998-01-01", "1999-01-01")


@query
def bars_range_stored(spark, folder):
    path = f"{shared_dir(spark)}/prices-{uuid.uuid4().hex}"
    files.write_ranged(fx.prices(spark, folder), path, "ticker", "date")
    return files.read_range(spark, path, "date", "1997-06-01", "1999-01-01", "ticker", ["S1", "^I4"])


@query
def bars_in_list(spark, folder):
    return cl.in_list(fx.prices(spark, folder), "ticker", ["S1", "^I4", "S9"])


@query
def clean_bars(spark, folder):
    return cl.clean_bars(fx.raw_bars(spark, folder))


@query
def clean_report(spark, folder):
    return cl.clean_report(fx.raw_bars(spark, folder))


@query
def null_counts(spark, folder):
    return cl.null_counts(fx.gap_bars(spark, folder))


@query
def zero_audit(spark, folder):
    return cl.zero_audit(fx.raw_bars(spark, folder))


@query
def zero_audit_by_key(spark, folder):
    return cl.zero_audit_by(fx.raw_bars(spark, folder), "ticker")


@query
def describe_by_key(spark, folder):
    return st.describe_by(fx.prices(spark, folder), "ticker", "close_price")


@query
def table_profile(spark, folder):
    return cl.profile(fx.gap_bars(spark, folder))


@query
def table_head(spark, folder):
    return cl.head(fx.prices(spark, folder), ["date", "ticker"], 10)


@query
def last_n(spark, folder):
    return se.last_n(ft.features(fx.prices(spark, folder)), "ticker", "date", 200).select(*KEY)


# Series

def _close(spark, folder):
    return fx.prices(spark, folder).select(*KEY)


@query
def daily_return(spark, folder):
    return se.pct_change(_close(spark, folder), *KEY)


@query
def lags(spark, folder):
    return se.lags(_close(spark, folder), *KEY)


@query
def target_label(spark, folder):
    return se.label_up(_close(spark, folder), *KEY)


@query
def sma(spark, folder):
    return se.sma(_close(spark, folder), *KEY, [10, 20, 50, 200])


@query
def bollinger(spark, folder):
    return se.bollinger(_close(spark, folder), *KEY)


@query
def rsi(spark, folder):
    return se.rsi(_close(spark, folder), *KEY)


@query
def ema(spark, folder):
    return se.ema(_close(spark, folder), *KEY, [9, 12, 26])


@query
def macd(spark, folder):
    return se.macd(_close(spark, folder), *KEY)


@query
def sma_cross(spark, folder):
    return se.sma_cross(_close(spark, folder), *KEY)


@query
def normalized_close(spark, folder):
    return se.rebase(_period(spark, folder).select(*KEY), *KEY)


@query
def filled_close(spark, folder):
    gaps = fx.gap_bars(spark, folder).select(*KEY)
    forward = od.fill(gaps, *KEY, out="carried")
    return od.fill(forward, *KEY, out="next_known", direction="backward")


@query
def features(spark, folder):
    return ft.features(fx.prices(spark, folder))


@query
def slice_indicators(spark, folder):
    rows, _ = backtest.sliced(settle(ft.features(fx.prices(spark, folder))), fx.PREDICT_FROM)
    return rows.select("ticker", "date", "close_price", "SMA_50", "RSI", "MACD", "Signal_Line", "MACD_Signal")


@query
def split_counts(spark, folder):
    parted = ft.date_split(ft.features(fx.prices(spark, folder)), "date", fx.PERIODS)
    return parted.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


# Matrices and densities

@query
def pivot_close(spark, folder):
    return st.pivot_by(fx.prices(spark, folder), "date", "ticker", fx.TICKERS, "close_price")


@query
def corr_ffill(spark, folder):
    return st.corr_matrix(fx.prices(spark, folder), *KEY, keys=fx.TICKERS, fill="ffill")


@query
def return_corr(spark, folder):
    table = ft.features(fx.prices(spark, folder))
    return st.corr_matrix(table, "ticker", "date", "Daily_Return", keys=fx.TICKERS, ready=True)


@query
def return_kde(spark, folder):
    returns = se.pct_change(_close(spark, folder), *KEY)
    return st.kde(returns, "ticker", "Daily_Return")


# Evaluation

@query
def confusion(spark, folder):
    return mt.confusion(fx.labels(spark, folder), "label", "pred")


@query
def class_report(spark, folder):
    return mt.class_report(fx.labels(spark, folder), "label", "pred")


@query
def roc_curve(spark, folder):
    return mt.roc_curve(fx.labels(spark, folder), "label", "score")


@query
def roc_auc(spark, folder):
    return mt.roc_auc(fx.labels(spark, folder), "label", "score")


# Signals, ledger and ranking

def _period(spark, folder):
    """The prediction period of the feature table."""
    return ft.features(fx.prices(spark, folder)).filter(F.col("date") >= F.lit(fx.PREDICT_FROM).cast("date"))


def _positions(spark, folder, first):
    """Positions of the prediction period under a strategy's rules, stored: several steps read them; and their layout."""
    table = settle(ft.features(fx.prices(spark, folder)))
    placed, laid = backtest.positions(table, fx.category(), fx.PREDICT_FROM, p=fx.chance(), first=first)
    return settle(placed.select("category", "ticker", "date", "open_price", "close_price", "Target", od.BUCKET,
                                sg.SIGNAL, sg.ACTION)), laid


_SIGNAL = ("ticker", "date", sg.SIGNAL, sg.ACTION)


def _signals(spark, folder, rule, first=False):
    table = settle(ft.features(fx.prices(spark, folder)))
    rows, laid = backtest.sliced(table, fx.PREDICT_FROM, first=first)
    return sg.signal(rows.withColumn("p", fx.chance()), "ticker", "date", *rule, laid=laid).select(*_SIGNAL)


@query
def signal_hybrid(spark, folder):
    return _signals(spark, folder, sg.hybrid_rule(), first=True)


@query
def signal_trend(spark, folder):
    return _signals(spark, folder, sg.trend_rule())


@query
def signal_macd(spark, folder):
    return _signals(spark, folder, sg.macd_rule())


_LEDGER = ("ticker", "date", "open_price", "close_price", sg.ACTION)


@query
def ledger_final(spark, folder):
    placed, laid = _positions(spark, folder, first=True)
    return lg.ledger_final(placed, *_LEDGER, laid=laid)


@query
def ledger_curve(spark, folder):
    placed, laid = _positions(spark, folder, first=True)
    return lg.ledger_curve(placed, *_LEDGER, laid=laid).select("ticker", "date", "portfolio_value")


@query
def buy_hold(spark, folder):
    return lg.buy_hold(_period(spark, folder), "ticker", "date", "open_price", "close_price")


@query
def best_by_category(spark, folder):
    best = lg.best_by(backtest.ranking(*_positions(spark, folder, first=False)), "category", "score", "ticker")
    return best.select("category", "ticker", "final_value", "benchmark", "score")


@query
def goal_verdict(spark, folder):
    return lg.verdict(lg.best_by(backtest.ranking(*_positions(spark, folder, first=False)), "category", "score", "ticker"))


@query
def hybrid_results(spark, folder):
    return backtest.valued(*_positions(spark, folder, first=True))


@query
def results_table(spark, folder):
    path = f"{shared_dir(spark)}/results-{uuid.uuid4().hex}"
    files.write_results(backtest.valued(*_positions(spark, folder, first=False)), path)
    return files.read_parquet(spark, path)


@query
def holdout_rows(spark, folder):
    table = ft.date_split(ft.features(fx.prices(spark, folder)), "date", fx.PERIODS)
    return table.filter(F.col("split") != "train").select("ticker", "date", "split", "Target")


@query
def holdout_support(spark, folder):
    table = ft.date_split(ft.features(fx.prices(spark, folder)), "date", fx.PERIODS)
    return table.groupBy("split", "Target").agg(F.count(F.lit(1)).alias("n"))


# Models, with the analysis's own settings (``models``).  SQL has no trees, so these have no SQL
# counterpart; tests hold their figures against loops over the table of nodes.  A model is fitted
# once per training table and settings and stored (``models.stored_fit``).

def _training(spark, folder):
    """The feature table with its periods, and the model inputs.

    The prices are stored first, because the features read them twice: to count and to compute.
    """
    table = settle(ft.features(settle(fx.prices(spark, folder))))
    return ft.date_split(table, "date", fx.PERIODS), ft.input_columns(table)


def _of(split):
    return F.col("split") == split


_SCORED = ("ticker", "date", "split", "Target", "p", "predicted")


@query
def gbt_scores(spark, folder):
    table, inputs = _training(spark, folder)
    path = study.boosted_model(table.filter(_of("train")), inputs)
    return study.scores(path, table.filter(~_of("train"))).select(*_SCORED)


@query
def rf_scores(spark, folder):
    table, inputs = _training(spark, folder)
    path = study.forest_model(table.filter(_of("train")), inputs)
    return study.scores(path, table.filter(~_of("train"))).select(*_SCORED)


@query
def model_report(spark, folder):
    table, inputs = _training(spark, folder)
    path = study.boosted_model(table.filter(_of("train")), inputs)
    return study.report(settle(study.scores(path, table.filter(_of("test"))).select("Target", "p", "predicted")))


@query
def feature_importance(spark, folder):
    table, inputs = _training(spark, folder)
    return study.importance(study.boosted_model(table.filter(_of("train")), inputs), table, inputs)


@query
def model_study(spark, folder):
    table, inputs = _training(spark, folder)
    path = study.boosted_model(table.filter(_of("train")), inputs)
    return study.study(path, table.filter(~_of("train")), inputs, "test")


def _strategy(spark, folder, first):
    """Results and ranking of a strategy run with the analysis's models, as one table."""
    valued, ranked = backtest.run(fx.prices(spark, folder), fx.category(), fx.PERIODS[0][2], fx.PREDICT_FROM, first=first)
    return valued.withColumn("part", F.lit("results")).unionByName(ranked.withColumn("part", F.lit("ranking")), allowMissingColumns=True)


@query
def first_strategy(spark, folder):
    return _strategy(spark, folder, True)


@query
def scan_strategy(spark, folder):
    return _strategy(spark, folder, False)
