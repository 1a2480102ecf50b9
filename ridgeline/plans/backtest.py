"""From the feature table to positions, valuations and the ranking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.operators import ledger as lg
from ridgeline.operators import models as md
from ridgeline.operators import signals as sg
from ridgeline.operators.features import RESEEDED, features, input_columns, period, slice_indicators
from ridgeline.operators.ordered import BUCKET, Layout, lay
from ridgeline.session import settle


def category_scores(table: DataFrame, rows: DataFrame, category: Column, train_before: str,
                    boosted=None, forest=None, label: str = "Target", first: bool = False) -> DataFrame:
    """``rows`` with ``p``: the forest's chance for stocks, the boosted trees' for indices.

    Both models are trained on all keys' rows before ``train_before``.  The ``first``
    strategy asks the boosted trees of the test settings about all keys.
    """
    inputs = [c for c in input_columns(table) if c != BUCKET]
    train = table.filter(F.col("date") < F.lit(train_before).cast("date"))

    def by(estimator, weighed):
        return md.load(md.stored_fit(weighed, inputs, estimator))

    if first:
        return md.score(by(boosted or md.boosted(label, **md.BOOSTED_TEST),
                           md.weigh_positive(train, label, md.BOOSTED_TEST["positive_weight"])), rows)
    trees = by(boosted or md.boosted(label, **md.BOOSTED_SCAN), md.weigh_positive(train, label, md.BOOSTED_SCAN["positive_weight"]))
    woods = by(forest or md.forest(label, **md.FOREST_SCAN), md.weigh_balanced(train, label))
    scored = [
        md.score(woods, rows.filter(category == "STOCKS")),
        md.score(trees, rows.filter(category == "INDICES")),
    ]
    return reduce(DataFrame.unionByName, scored)


def run(prices: DataFrame, category: Column, train_before: str, lo: str, hi: str | None = None,
        boosted=None, forest=None, first: bool = False) -> tuple[DataFrame, DataFrame]:
    """Cleaned prices to the results table and the ranking of all keys; ``first`` for the first strategy.

    The prices, the feature table, the scored slice and the positions are stored on the way:
    each is read by more than one later step.
    """
    table = settle(features(settle(prices)))
    rows, laid = sliced(table, lo, hi, first)
    scored = settle(category_scores(table, rows, category, train_before, boosted, forest, first=first))
    placed = settle(choose(scored, category, first, laid))
    moves = known_trades(placed, laid)
    return valued(placed, laid, moves), ranking(placed, laid, moves)


def sliced(table: DataFrame, lo: str, hi: str | None = None, first: bool = False) -> tuple[DataFrame, Layout]:
    """The period's rows, stored with their bucket, and their layout; the first strategy starts only the 50-row mean afresh.

    The rows are laid out once: indicators, signals and the ledger of the period all work on these buckets.
    """
    laid_out, laid = lay(period(table, "date", lo, hi), "ticker", "date")
    return settle(slice_indicators(laid_out, lo, hi, reseed=("SMA_50",) if first else RESEEDED, laid=laid)), laid


def positions(table: DataFrame, category: Column, lo: str, hi: str | None = None, p: Column | None = None,
              first: bool = False) -> tuple[DataFrame, Layout]:
    """Signals of the slice: the MACD rule for stocks, the trend rule for indices; the hybrid rule in the ``first`` strategy.

    ``table`` is read twice (to count and to compute); store it unless it is a source.
    """
    rows, laid = sliced(table, lo, hi, first)
    if p is not None:
        rows = rows.withColumn("p", p)
    return choose(rows, category, first, laid), laid


def choose(rows: DataFrame, category: Column, first: bool = False, laid: Layout | None = None) -> DataFrame:
    """Signals from each category's rule on a table that has ``p``; the ``first`` strategy has one rule for both."""
    rows = rows.withColumn("category", category)
    if first:
        return sg.signal(rows, "ticker", "date", *sg.hybrid_rule(), laid=laid)
    stock = F.col("category") == "STOCKS"
    on, off = zip(sg.macd_rule(), sg.trend_rule())
    return sg.signal(rows, "ticker", "date",
                     F.when(stock, on[0]).otherwise(on[1]), F.when(stock, off[0]).otherwise(off[1]), laid=laid)


_LEDGER = ("date", "open_price", "close_price", sg.ACTION)
_KEYS = ["category", "ticker"]


def known_trades(placed: DataFrame, laid: Layout | None = None) -> DataFrame:
    """The trades of a position table, from which values and ranking both follow."""
    return lg.trades(placed, _KEYS, "date", "open_price", sg.ACTION, laid=laid)


def valued(placed: DataFrame, laid: Layout | None = None, moves: DataFrame | None = None) -> DataFrame:
    """The results table of a position table."""
    return lg.results(lg.ledger_curve(placed, _KEYS, *_LEDGER, laid=laid, moves=moves))


def ranking(placed: DataFrame, laid: Layout | None = None, moves: DataFrame | None = None) -> DataFrame:
    """Ledger against buy-and-hold per key of a position table."""
    finals = lg.ledger_final(placed, _KEYS, *_LEDGER, laid=laid, moves=moves)
    held = lg.buy_hold(placed, _KEYS, "date", "open_price", "close_price")
    return lg.scores(finals, held, _KEYS)
