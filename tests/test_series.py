"""Indicators against pandas, on whole keys and on many small parts."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ridgeline.functions import indicators as ind
from ridgeline.operators import clean as cl
from ridgeline.operators import features as ft
from ridgeline.operators import series as se
from tests.data import collected, series, shuffled, walk

KEY = ("ticker", "date", "close_price")
LAYOUTS = [{}, {"rows": 60, "width": 10}, {"rows": None}]
SIZES = {"hot": 900, "mid": 120, "two": 2, "one": 1}


@pytest.fixture(scope="module")
def bars():
    return walk(SIZES).sort_values(["ticker", "date"]).reset_index(drop=True)


def strengths(prices):
    """By its definition: of 14 rows, the rows' gains as a share of all that moved; the first row moved by nothing."""
    prices, out = list(prices), []
    for i in range(len(prices)):
        moves = [prices[j] - prices[j - 1] if j else 0.0 for j in range(i - 13, i + 1)] if i >= 13 else []
        gains, all_moves = sum(m for m in moves if m > 0), sum(abs(m) for m in moves)
        out.append(100 * gains / all_moves if all_moves else np.nan)
    return out


def per_key(bars, fn):
    return bars.groupby("ticker").close_price.transform(fn)


def close_to(got, want, rtol=1e-10, atol=1e-11):
    np.testing.assert_allclose(got.astype(float), want.astype(float), rtol=rtol, atol=atol)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_returns_lags_and_label(spark, bars, layout):
    df = shuffled(spark, bars)
    close_to(collected(se.pct_change(df, *KEY, **layout)).Daily_Return, per_key(bars, lambda s: s.pct_change()))
    got = collected(se.lags(df, *KEY, **layout))
    for n in (1, 2, 5):
        close_to(got[f"Lag_{n}"], per_key(bars, lambda s: s.shift(n)))
    close_to(got.Price_Change, per_key(bars, lambda s: s.diff()))
    got = collected(se.label_up(df, *KEY, **layout))
    after = per_key(bars, lambda s: s.shift(-1))
    close_to(got.Next_Close, after)
    assert list(got.Target) == list((after > bars.close_price).astype(int))


@pytest.mark.parametrize("layout", LAYOUTS)
def test_rolling(spark, bars, layout):
    df = shuffled(spark, bars)
    got = collected(se.sma(df, *KEY, [10, 50], **layout))
    close_to(got.SMA_10, per_key(bars, lambda s: s.rolling(10).mean()))
    close_to(got.SMA_50, per_key(bars, lambda s: s.rolling(50).mean()))
    got = collected(se.bollinger(df, *KEY, **layout))
    mid, sd = per_key(bars, lambda s: s.rolling(20).mean()), per_key(bars, lambda s: s.rolling(20).std())
    close_to(got.Bollinger_Std, sd, 1e-8)
    close_to(got.Bollinger_Upper, mid + 2 * sd, 1e-9)
    close_to(got.Bollinger_Lower, mid - 2 * sd, 1e-9)
    close_to(collected(se.rsi(df, *KEY, **layout)).RSI, per_key(bars, strengths), 1e-9)


@pytest.mark.parametrize("layout", [{}, {"rows": 700, "width": 50}, {"rows": 60, "width": 10}])
def test_exponential_means_over_many_blocks(spark, layout):
    bars = walk({"hot": 6000, "mid": 120, "one": 1}, seed=2).sort_values(["ticker", "date"]).reset_index(drop=True)
    df = shuffled(spark, bars)

    def mean(span):
        return lambda s: s.ewm(span=span, adjust=False).mean()
    got = collected(se.ema(df, *KEY, [9, 12, 26], **layout))
    for span in (9, 12, 26):
        close_to(got[f"EMA_{span}"], per_key(bars, mean(span)), 1e-13)
    got = collected(se.macd(df, *KEY, **layout))
    line = per_key(bars, mean(12)) - per_key(bars, mean(26))
    close_to(got.MACD, line, 1e-9, 1e-10)
    close_to(got.MACD_Signal, line.groupby(bars.ticker).transform(mean(9)), 1e-9, 1e-10)


def test_spans_too_far_apart_for_one_block(spark):
    bars = walk({"a": 3000}, seed=4).sort_values("date").reset_index(drop=True)
    got = collected(se.ema(shuffled(spark, bars), *KEY, [2, 9, 120]))
    for span in (2, 9, 120):
        close_to(got[f"EMA_{span}"], bars.close_price.ewm(span=span, adjust=False).mean(), 1e-12)


@pytest.mark.parametrize("layout", [{"rows": None}, {"rows": 900, "width": 30}, {"rows": 70, "width": 5}])
def test_a_past_far_above_the_present(spark, layout):
    # After a fall by forty orders of magnitude the far past still counts, however the rows are laid out.
    closes = [1e40] * 800 + [1.0 + i % 7 for i in range(1200)]
    pdf = series("a", closes)
    got = collected(se.ema(shuffled(spark, pdf), *KEY, 26, **layout))
    want = pdf.close_price.ewm(span=26, adjust=False).mean()
    close_to(got.EMA_26[800:], want[800:], 1e-6)
    assert want[923] > 1e9


def test_missing_price_stops_an_exponential_mean(spark):
    df = spark.createDataFrame(series("a", [100.0, 100.0, 7.0, 200.0, 200.0])).withColumn(
        "close_price", F.when(F.col("close_price") != 7.0, F.col("close_price")))
    with pytest.raises(Exception, match="an exponential mean needs every close_price"):
        se.ema(df, *KEY, 9).collect()


def test_strength_by_hand(spark):
    # 13 rises of 1 after the first row, then a fall of 4: 13 gained of 17 moved in the last 14 rows.
    got = collected(se.rsi(shuffled(spark, series("a", [*range(10, 24), 19])), *KEY)).RSI.tolist()
    assert got[13] == 100.0 and got[14] == pytest.approx(100 * 13 / 17)


def test_flat_series_has_exactly_no_trend(spark):
    got = collected(se.macd(shuffled(spark, series("a", [123.456] * 2000)), *KEY))
    assert (got.MACD == 0).all() and (got.MACD_Signal == 0).all()


def test_strength_index_edges(spark):
    rising = series("up", range(1, 41))
    flat = series("flat", [7] * 40)
    short = series("short", [1, 2, 1, 3, 2, 4, 3, 5, 4, 6, 5, 7, 6])
    got = collected(se.rsi(shuffled(spark, pd.concat([rising, flat, short])), *KEY))
    up = got[got.ticker == "up"].RSI.tolist()
    assert np.isnan(up[:13]).all() and up[13:] == [100.0] * 27
    assert got[got.ticker != "up"].RSI.isna().all()


@pytest.mark.parametrize("layout", LAYOUTS)
def test_crossings(spark, layout):
    bars = walk({"hot": 1200, "mid": 250, "short": 30}, seed=7).sort_values(["ticker", "date"]).reset_index(drop=True)
    diff = per_key(bars, lambda s: s.rolling(20).mean()) - per_key(bars, lambda s: s.rolling(60).mean())
    side = np.sign(diff).fillna(0)
    changed = side != side.groupby(bars.ticker).shift()
    want = bars.assign(event=np.where(side > 0, "golden", "death"))[changed & (side != 0)]
    got = collected(se.sma_cross(shuffled(spark, bars), *KEY, 20, 60, **layout))
    assert list(zip(got.ticker, got.date, got.event)) == list(zip(want.ticker, want.date, want.event))
    later = collected(se.sma_cross(shuffled(spark, bars), *KEY, 20, 60, skip_warmup=True, **layout))
    assert len(later) == len(got) - 2


def test_touching_zero_counts_again(spark):
    # short mean minus long mean: positive, exactly level, positive
    closes = [1, 1, 3, 3, 3, 3, 3, 5]
    got = collected(se.sma_cross(shuffled(spark, series("a", closes)), *KEY, 1, 3))
    assert [(r.date.day, r.event) for r in got.itertuples()] == [(3, "golden"), (8, "golden")]


def test_last_rows_and_rebase(spark, bars):
    df = shuffled(spark, bars)
    got = collected(se.last_n(df, "ticker", "date", 25))
    want = bars.groupby("ticker").tail(25).reset_index(drop=True)
    assert list(zip(got.ticker, got.date)) == list(zip(want.ticker, want.date))
    close_to(collected(se.rebase(df, *KEY)).normalized, per_key(bars, lambda s: s / s.iloc[0] * 100_000))


def test_limit_per_key_before_the_shuffle(spark, bars):
    plan = se.last_n(shuffled(spark, bars), "ticker", "date", 5)._jdf.queryExecution().toString()
    assert "row_number(), 5, Partial" in plan


@pytest.mark.parametrize("layout", LAYOUTS)
def test_feature_table(spark, layout):
    raw = walk({"hot": 1500, "mid": 80, "short": 30}, seed=9).sort_values(["ticker", "date"]).reset_index(drop=True)
    raw = raw.assign(high_price=raw.close_price, low_price=raw.close_price, adj_close=raw.close_price, volume=5)
    table = ft.features(shuffled(spark, raw), **layout)
    got = collected(table)
    assert got.groupby("ticker").size().to_dict() == {"hot": 1450, "mid": 30}
    assert len(ft.input_columns(table)) == 23
    want = raw.assign(RSI=per_key(raw, strengths), DayOfWeek=pd.to_datetime(raw.date).dt.dayofweek,
                      Month=pd.to_datetime(raw.date).dt.month)
    both = got.merge(want, on=["ticker", "date"], suffixes=("", "_w"))
    close_to(both.RSI, both.RSI_w, 1e-9)
    assert (both.DayOfWeek == both.DayOfWeek_w).all() and (both.Month == both.Month_w).all()


@pytest.mark.parametrize("layout", [{}, {"rows": 60, "width": 10}])
def test_slice_starts_its_indicators_afresh(spark, layout):
    raw = walk({"hot": 1500, "mid": 700}, seed=9).sort_values(["ticker", "date"]).reset_index(drop=True)
    raw = raw.assign(high_price=raw.close_price, low_price=raw.close_price, adj_close=raw.close_price, volume=5)
    table = spark.createDataFrame(collected(ft.features(shuffled(spark, raw))))
    got = collected(ft.slice_indicators(table, "2001-01-01", "2004-12-31", **layout))
    part = collected(table.filter("date >= '2001-01-01' and date <= '2004-12-31'"))
    assert len(got) == len(part)
    group = part.groupby("ticker").close_price
    line = group.transform(lambda s: s.ewm(span=12, adjust=False).mean() - s.ewm(span=26, adjust=False).mean())
    close_to(got.MACD, line, 1e-9, 1e-10)
    close_to(got.Signal_Line, line.groupby(part.ticker).transform(lambda s: s.ewm(span=9, adjust=False).mean()),
             1e-9, 1e-10)
    close_to(got.RSI, group.transform(strengths).fillna(50), 1e-9)
    close_to(got.SMA_50, group.transform(lambda s: s.rolling(50).mean().bfill()))
    kept = collected(ft.slice_indicators(table, "2001-01-01", reseed=()))
    close_to(kept.Signal_Line, kept.MACD_Signal)
    # The first strategy starts only the mean afresh.
    own = collected(ft.slice_indicators(table, "2001-01-01", "2004-12-31", reseed=("SMA_50",), **layout))
    close_to(own.SMA_50, got.SMA_50)
    close_to(own.MACD, part.MACD)
    close_to(own.RSI, part.RSI)


def test_periods_are_half_open(spark):
    df = spark.sql("""SELECT explode(array(date'2019-12-31', date'2020-01-01', date'2022-12-31', date'2023-01-01',
                                           date'2024-01-01', date'2030-01-01')) AS date""")
    got = [r.split for r in ft.date_split(df, "date").orderBy("date").collect()]
    assert got == ["train", "test", "test", "validation", "prediction", "prediction"]
    assert ft.date_split(df, "date", [("x", "2020-01-01", "2021-01-01")]).filter(F.col("split").isNull()).count() == 5


def test_scans_read_only_what_is_used(spark, bars, tmp_path):
    path = str(tmp_path / "prices")
    spark.createDataFrame(bars.assign(volume=5, high_price=1.0, low_price=1.0)).write.parquet(path)
    prices = spark.read.parquet(path)
    plan = se.sma(prices, *KEY, 10).select("ticker", "SMA_10")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "close_price" in line)
    assert "ReadSchema: struct<ticker:string,date:date,close_price:double>" in scan
    plan = cl.between(prices, "date", "2000-02-01", "2000-03-01")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2000-02-01), LessThan(date,2000-03-01)" in plan


@pytest.mark.parametrize("layout", [{}, {"rows": 150, "width": 20}])
def test_means_of_any_length(spark, layout):
    """Prime lengths, lengths without a common divisor, and gaps among the values."""
    bars = walk({"hot": 1500, "mid": 230, "one": 1}, seed=6).sort_values(["ticker", "date"]).reset_index(drop=True)
    bars.loc[np.random.default_rng(2).random(len(bars)) < 0.003, "close_price"] = np.nan
    df = shuffled(spark, bars).withColumn("close_price", F.nanvl("close_price", F.lit(None).cast("double")))
    lengths = [1, 2, 7, 8, 9, 13, 199, 200]
    got = collected(se.sma(df, *KEY, lengths, **layout))
    for n in lengths:
        want = per_key(bars, lambda s, n=n: s.rolling(n).apply(np.mean, raw=True))
        assert (got[f"SMA_{n}"].isna() == want.isna()).all()
        close_to(got[f"SMA_{n}"], want, 1e-10)


def test_plan_does_not_grow_with_the_length(spark, bars):
    df = shuffled(spark, bars)
    sizes = [len(se.sma(df, *KEY, n)._jdf.queryExecution().optimizedPlan().toString()) for n in (199, 1999, 19_997)]
    assert sizes[2] < 2.5 * sizes[0]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_exponential_means_stay_in_the_engine(spark, bars):
    df = shuffled(spark, bars)
    raw = df.withColumns({c: F.col("close_price") for c in ("high_price", "low_price", "adj_close")}).withColumn("volume", F.lit(5))
    for made in (se.ema(df, *KEY, [9, 12, 26]), se.macd(df, *KEY), ft.features(raw)):
        plan = plan_of(made)
        assert "pow" in plan.lower() and "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_unread_features_are_not_computed(spark, bars):
    raw = shuffled(spark, bars).withColumns({c: F.col("close_price") for c in ("high_price", "low_price", "adj_close")}).withColumn("volume", F.lit(5))
    table = ft.features(raw)
    assert "pow" in plan_of(table).lower()
    for made in (se.last_n(table, "ticker", "date", 20).select(*KEY), ft.date_split(table, "date").groupBy("split").count(),
                 table.select("ticker", "date", "open_price", "close_price")):
        plan = plan_of(made).lower()
        assert "pow" not in plan and "_gap_" not in plan and "bollinger" not in plan and "_sum10_" in plan


def test_groups_of_spans():
    for spans in ([9, 12, 26], [2, 9, 120], [1, 1000], [5]):
        groups = ind._groups(spans)
        assert sorted(s for _, g in groups for s in g) == sorted(spans)
        for block, before in groups:
            for s, n in before.items():
                assert block * ind.nats(s) <= ind.BLOCK_NATS + 1e-9 or block == 1
                assert n * block * ind.nats(s) >= ind.FADED_NATS
    assert len(ind._groups([9, 12, 26])) == 1
