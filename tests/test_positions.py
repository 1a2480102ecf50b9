import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ridgeline.operators import features as ft
from ridgeline.operators import ledger as lg
from ridgeline.operators import models as md
from ridgeline.operators import signals as sg
from ridgeline.plans import backtest, evaluation
from tests.data import START, collected, shuffled, walk

SIZES = {"hot": 900, "mid": 60, "one": 1}


CASH, FEE = 100_000.0, 0.001


def assert_follows_rules(opens, closes, actions, values, moves):
    """A valued ledger keeps every rule: ``moves`` are (row, cash, units) after each trade."""
    at = {row: (cash, units) for row, cash, units in moves}
    cash, units = CASH, 0.0
    for i, (price, close, action, value) in enumerate(zip(opens, closes, actions, values)):
        most = np.floor(cash * (1 - FEE) / price) if price > 0 else 0.0
        after, held = at.get(i, (cash, units))
        if i not in at:
            # Nothing happens only if there is nothing to buy with, or nothing to sell.
            assert (cash <= price or most == 0 or price <= 0) if action else units == 0
        elif action:
            assert held - units == most > 0 and price < cash
            assert after == pytest.approx(cash - most * price - most * price * FEE, rel=1e-12, abs=1e-6)
        else:
            assert held == 0 < units
            assert after - cash == pytest.approx(units * price - units * price * FEE, rel=1e-9, abs=1e-6)
        cash, units = after, held
        assert value == pytest.approx(cash + units * close, rel=1e-12)


@pytest.mark.parametrize("width", [None, 3])
def test_signal_holds_and_action_follows_a_row_later(spark, width):
    pdf = walk(SIZES).assign(p=lambda d: np.random.default_rng(1).random(len(d)))
    df = shuffled(spark, pdf)
    got = collected(sg.signal(df, "ticker", "date", F.col("p") > 0.97, F.col("p") < 0.03, width=width))
    for _, rows in got.groupby("ticker"):
        want, state = [], 0
        for p in rows.p:
            state = 1 if p > 0.97 else 0 if p < 0.03 else state
            want.append(state)
        assert list(rows.model_prediction) == want
        assert list(rows.strategy_action) == [0, *want[:-1]]


def test_rules(spark):
    rows = [  # p, price, mean, line, smoothed, strength -> hybrid, trend, macd from an even start (None: hold)
        (0.46, 1.0, 2.0, 1.0, 0.0, 50.0, 1, 1, 1),
        (0.45, 1.0, 2.0, 0.0, 0.0, 50.0, None, None, None),
        (0.42, 1.0, 2.0, 0.0, 0.0, 81.0, None, None, 0),
        (0.40, 1.0, 2.0, 1.0, 0.0, 50.0, None, None, None),
        (0.30, 1.0, 2.0, 0.0, 1.0, 50.0, None, 0, 0),
        (0.20, 3.0, 2.0, 1.0, 0.0, 90.0, None, 1, 0),
        (0.20, 1.0, 2.0, 1.0, 0.0, None, 0, 0, None),
        (0.20, 1.0, None, 1.0, 0.0, None, 0, 0, None),
    ]
    df = spark.createDataFrame(rows, """p double, close_price double, SMA_50 double, MACD double, Signal_Line double,
                                        RSI double, want_hybrid int, want_trend int, want_macd int""")
    for name, (on, off) in {"hybrid": sg.hybrid_rule(), "trend": sg.trend_rule(), "macd": sg.macd_rule()}.items():
        got = df.select(F.when(on, 1).when(off, 0).alias("got"), f"want_{name}").collect()
        assert [r.got for r in got] == [r[f"want_{name}"] for r in got], name


@pytest.fixture(scope="module")
def placed():
    rng = np.random.default_rng(8)
    pdf = walk(SIZES, seed=3)
    flips = rng.random(len(pdf)) < 0.1
    return pdf.assign(act=(np.cumsum(flips) % 2).astype(int)).sort_values(["ticker", "date"]).reset_index(drop=True)


def checked(spark, pdf, columns, **options):
    """Values per key, after every key's ledger has been held against the rules."""
    df = shuffled(spark, pdf)
    got = collected(lg.ledger_curve(df, *columns, **options))
    moves = lg.trades(df, *columns[:3], columns[4]).toPandas()
    for key, rows in got.groupby("ticker"):
        place = {d: i for i, d in enumerate(rows.date)}
        own = [(place[m.date], m.cash, m.units) for m in moves[moves.ticker == key].itertuples()]
        assert_follows_rules(rows[columns[2]], rows[columns[3]], rows[columns[4]], rows.portfolio_value, own)
    return got


@pytest.mark.parametrize("rows", [lg.ROUND, 50])
def test_ledger_keeps_the_rules(spark, placed, rows, monkeypatch):
    monkeypatch.setattr(lg, "ROUND", rows)
    columns = ("ticker", "date", "open_price", "close_price", "act")
    got = checked(spark, placed, columns, width=20)
    final = lg.ledger_final(shuffled(spark, placed), *columns).toPandas().set_index("ticker").final_value
    ends = got.groupby("ticker").portfolio_value.last()
    np.testing.assert_allclose(final[ends.index], ends, rtol=1e-12)


def test_ledger_by_hand(spark):
    """Buys with what is left, needs more cash than the price, sells all."""
    rows = [(60_000.0, 60_000.0, 1), (30_000.0, 31_000.0, 1), (200_000.0, 1.0, 0), (500_000.0, 2.0, 1)]
    df = spark.createDataFrame([("a", START + dt.timedelta(i), *r) for i, r in enumerate(rows)],
                               "ticker string, date date, o double, c double, act int")
    got = collected(lg.ledger_curve(df, "ticker", "date", "o", "c", "act")).portfolio_value
    # One unit at 60,060, one more at 30,030 of the 39,940 left, both sold at 199,800 each.
    np.testing.assert_allclose(got, [99_940.0, 9_910.0 + 62_000.0, 409_510.0, 409_510.0])
    assert lg.trades(df, "ticker", "date", "o", "act").count() == 3


def test_opens_of_zero(spark):
    """A due sale happens at a price of 0; nothing is bought there."""
    rows = [(10.0, 10.0, 1), (0.0, 5.0, 0), (20.0, 20.0, 0), (0.0, 1.0, 1), (None, 1.0, 1)]
    df = spark.createDataFrame([("a", START + dt.timedelta(i), *r) for i, r in enumerate(rows)],
                               "ticker string, date date, o double, c double, act int")
    got = collected(lg.ledger_curve(df, "ticker", "date", "o", "c", "act")).portfolio_value.tolist()
    # 9,990 units for 99,999.9 with the fee; what is left is ten cents.
    np.testing.assert_allclose(got, [99_900.1 - 0.0, 0.1, 0.1, 0.1, 0.1], atol=1e-6)


def test_benchmark_ranking_and_verdict(spark):
    df = spark.createDataFrame([("a", START, 10.0, 11.0), ("a", START + dt.timedelta(1), 12.0, 20.0),
                                ("big", START, 2e5, 2e5)], "ticker string, date date, o double, c double")
    got = {r.ticker: r.benchmark for r in lg.buy_hold(df, "ticker", "date", "o", "c").collect()}
    assert got == {"a": 9990 * 20.0, "big": 1.0}
    ranked = spark.createDataFrame([("STOCKS", "a", 1.5), ("STOCKS", "b", 1.5), ("STOCKS", "c", None), ("INDICES", "x", 1.3)],
                                   "category string, ticker string, score double")
    best = lg.best_by(ranked, "category", "score", "ticker")
    assert sorted((r.category, r.ticker) for r in best.collect()) == [("INDICES", "x"), ("STOCKS", "a")]
    assert lg.verdict(best).first().verdict == "both passed"
    assert lg.verdict(best.filter("category = 'INDICES'")).first().verdict == "index passed"
    assert lg.verdict(best.filter("category = 'STOCKS'")).first().verdict == "not passed"


def test_prices_to_results(spark):
    raw = walk({"S": 700, "T": 40, "^I": 700}, seed=12)
    raw = raw.assign(high_price=raw.close_price, low_price=raw.close_price, adj_close=raw.close_price, volume=5)
    kind = F.when(F.col("ticker").startswith("^"), "INDICES").otherwise("STOCKS")
    results, ranked = backtest.run(shuffled(spark, raw), kind, "2002-01-01", "2002-01-01", "2003-06-30",
                                   md.boosted(trees=3, depth=3), md.forest(trees=4, depth=3))
    assert results.columns == ["date", "ticker", "close_price", "Target", "model_prediction", "strategy_action",
                               "portfolio_value"]
    got = collected(results)
    assert set(got.ticker) == {"S", "^I"} and str(got.date.min()) >= "2002-01-01" and str(got.date.max()) <= "2003-06-30"
    opens = got.merge(raw[["ticker", "date", "open_price"]], on=["ticker", "date"])
    for key, rows in opens.groupby("ticker"):
        df = spark.createDataFrame(rows[["ticker", "date", "open_price", "close_price", "strategy_action"]])
        own = lg.trades(df, "ticker", "date", "open_price", "strategy_action").toPandas()
        place = {d: i for i, d in enumerate(rows.date)}
        assert_follows_rules(rows.open_price, rows.close_price, rows.strategy_action, rows.portfolio_value,
                             [(place[m.date], m.cash, m.units) for m in own.itertuples()])
        line, last = ranked.filter(F.col("ticker") == key).first(), rows.portfolio_value.iloc[-1]
        assert line.final_value == pytest.approx(last) and line.score == pytest.approx(last / line.benchmark)


def test_scores_are_repeatable_chances(spark):
    raw = walk({"S": 300}, seed=12)
    raw = raw.assign(high_price=raw.close_price, low_price=raw.close_price, adj_close=raw.close_price, volume=5)
    table = spark.createDataFrame(collected(ft.features(shuffled(spark, raw)))).coalesce(1)
    inputs = ft.input_columns(table)
    train = md.weigh_positive(table, "Target", 2.0)
    first, again = (collected(md.score(md.fit(train, inputs, md.boosted(trees=3, depth=3)), table)) for _ in range(2))
    assert first.p.between(0, 1).all() and (first.p == again.p).all()
    assert ((first.p > 0.5).astype(int) == first.predicted).all()
    found = evaluation.evaluate(md.fit(train, inputs, md.boosted(trees=3, depth=3)), inputs, table, top=5)
    lines = {r["class"]: r for r in found["report"].collect()}
    assert lines["accuracy"].f1 == pytest.approx((first.predicted == first.Target).mean())
    assert found["confusion"].agg(F.sum("n")).first()[0] == len(first) and found["importance"].count() == 5
    assert 0.5 < found["auc"].first().auc <= 1 and found["roc"].count() == first.p.nunique()


def test_weights_and_importance(spark):
    df = spark.createDataFrame([(float(i % 7), float(i), int(i % 4 == 0)) for i in range(80)], "u double, v double, Target int")
    weights = {r.Target: r._weight for r in md.weigh_balanced(df, "Target").distinct().collect() if r.v < 2}
    assert weights == {1: 2.0, 0: pytest.approx(2 / 3)}
    model = md.fit(md.weigh_positive(df, "Target", 2.0), ["u", "v"], md.boosted(trees=2, depth=2))
    top = md.importance(model, ["u", "v"], spark, 1).collect()
    assert len(top) == 1 and 0 < top[0].importance <= 1
