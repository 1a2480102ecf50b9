"""Whole-unit ledger of a 0/1 position, its buy-and-hold benchmark and the ranking.

How many units a purchase gets depends on the cash all earlier trades left, so
trades have to be worked out one after the other.  Only that runs in sequence:
rows on which nothing can happen are dropped beforehand, four narrow columns of
the rest stream through a task in time order with two numbers as state and no
row kept, a bounded number of rows per key and round, and the valuation of every
row is spread over parts of a key again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.functions.columns import missing, names
from ridgeline.operators.ordered import BUCKET, Layout, hand_over, over_series, split
from ridgeline.session import settle, shared_dir

# Starting cash and the fee per trade.
CASH = 100_000.0
FEE = 0.001

# Rows of one key that one task works off in a round.
ROUND = 1_000_000


def trades(df: DataFrame, k, t: str, o: str, action: str, cash: float = CASH, fee: float = FEE,
           laid: Layout | None = None) -> DataFrame:
    """Cash and units after each row on which something was bought or sold.

    With action 1 and more cash than the opening price, as many whole units as
    the cash less fee covers are bought, also on later rows from what was left;
    with action 0 all units are sold, also at a price of 0.  Nothing is bought at a
    price of 0 or less, and on a row without a price nothing happens.

    Runs jobs: the rows that can matter are stored in parts of about a million
    per key.  The parts are worked off in rounds, each from the state the round
    before left, so no task takes more rows of a key than a part has.  With ``laid`` parts are cut
    by the rows of the layout, of which those that can matter are at most all, and the
    bucket of each trade is returned too.
    """
    keys = names(k)
    held = [BUCKET] if laid else []
    fold = _fold([*keys], t, cash, fee, held)
    schema = T.StructType([*[df.schema[c] for c in [*keys, t, *held]],
                           T.StructField("cash", T.DoubleType()), T.StructField("units", T.DoubleType())])
    fresh = {"_cash": F.lit(float(cash)), "_units": F.lit(0.0)}
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/trades-{uuid.uuid4().hex}"
    possible = _possible(df, keys, t, o, action, laid)
    if not laid:
        possible = settle(possible)  # counted and stored
    parts, seen = split(possible, keys, t, rows=ROUND, laid=laid).drop("_home"), Observation()
    parts.observe(seen, F.max("_part").alias("last")).write.partitionBy("_part").parquet(f"{folder}/rows")
    stored = spark.read.schema(T.StructType([*possible.schema, T.StructField("_part", T.LongType())])).parquet(f"{folder}/rows")
    last = seen.get["last"]
    moves, state = [], None
    for number in range((-1 if last is None else last) + 1):
        part = stored.filter(F.col("_part") == number).drop("_part")
        if state is None:
            part = part.withColumns(fresh)
        else:
            part = part.join(state.select(*keys, F.col("cash").alias("_cash"), F.col("units").alias("_units")), keys, "left")
            part = part.withColumns({c: F.coalesce(F.col(c), start) for c, start in fresh.items()})
        work = part.repartition(*keys).sortWithinPartitions(*keys, t).mapInPandas(fold, schema)
        moves.append(settle(work))
        known = moves[-1].drop(*held) if state is None else state.unionByName(moves[-1].drop(*held))
        if number < last:
            state = settle(known.groupBy(*keys).agg(F.max_by(F.struct(t, "cash", "units"), t).alias("s")).select(*keys, "s.*"))
    return reduce(DataFrame.unionByName, moves) if moves else spark.createDataFrame([], schema)


def _possible(df: DataFrame, keys: list[str], t: str, o: str, action: str, laid: Layout | None = None) -> DataFrame:
    """Rows on which a trade can happen, narrowed to what the fold reads.

    After a row without position nothing is left to sell, so a row with action 0
    matters only behind one with action 1.
    """
    held = [BUCKET] if laid else []
    rows = df.filter(~missing(df, o)).select(
        *keys, t, *held, F.col(o).cast("double").alias("_open"), F.col(action).cast("int").alias("_act"))
    was = F.coalesce(F.col("_was"), F.lit(0))
    return over_series(
        rows, keys, t, 1,
        lambda d, w: d.withColumn("_was", F.lag("_act").over(w)).filter((F.col("_act") == 1) | (was == 1)), laid=laid
    ).select(*keys, t, *held, "_open", "_act")


def _fold(keys: list[str], t: str, cash: float, fee: float, held_over: list[str] = ()):
    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        owner, money, held = None, cash, 0
        for batch in batches:
            done, after = [], []
            columns = [*[batch[c].tolist() for c in keys],
                       *[batch[c].tolist() for c in ("_open", "_act", "_cash", "_units")]]
            for i, (*who, price, act, money_before, held_before) in enumerate(zip(*columns)):
                if who != owner:
                    owner, money, held = who, money_before, int(held_before)
                bought = int(money * (1 - fee) / price) if act == 1 and 0 < price < money else 0
                if bought > 0:
                    money -= bought * price * (1 + fee)
                    held += bought
                elif act == 0 and held > 0:
                    money += held * price * (1 - fee)
                    held = 0
                else:
                    continue
                done.append(i)
                after.append((money, float(held)))
            if done:
                out = batch.iloc[done][[*keys, t, *held_over]].reset_index(drop=True)
                yield out.assign(cash=[a[0] for a in after], units=[a[1] for a in after])
    return fold


def ledger_final(df: DataFrame, k, t: str, o: str, c: str, action: str,
                 cash: float = CASH, fee: float = FEE, laid: Layout | None = None, moves: DataFrame | None = None) -> DataFrame:
    """Value of each key's ledger on its last row; ``moves`` are its ``trades`` where they are known already."""
    keys = names(k)
    last = df.groupBy(*keys).agg(F.max_by(c, t).alias("_close"))
    state = (trades(df, keys, t, o, action, cash, fee, laid) if moves is None else moves).groupBy(*keys).agg(
        F.max_by(F.struct("cash", "units"), t).alias("_state"))
    value = F.col("_state.cash") + F.col("_state.units") * F.col("_close")
    return last.join(state, keys, "left").select(*keys, F.coalesce(value, F.lit(cash)).alias("final_value"))


def ledger_curve(df: DataFrame, k, t: str, o: str, c: str, action: str, cash: float = CASH,
                 fee: float = FEE, width: int | None = None, laid: Layout | None = None,
                 moves: DataFrame | None = None) -> DataFrame:
    """Every row with ``portfolio_value``, the ledger's worth at its close; ``moves`` as in ``ledger_final``."""
    keys = names(k)
    moves = trades(df, keys, t, o, action, cash, fee, laid) if moves is None else moves
    state = F.when(F.col("_late") == 0, F.struct("cash", "units"))
    both = df.withColumn("_late", F.lit(1)).unionByName(
        moves.withColumn("_late", F.lit(0)), allowMissingColumns=True)
    start = F.struct(F.lit(cash).alias("cash"), F.lit(0.0).alias("units"))
    known = hand_over(both, keys, t, state, "_state", start=start, width=width, tie="_late", laid=laid)
    value = F.col("_state.cash") + F.col("_state.units") * F.col(c)
    return known.filter("_late = 1").select(*df.columns, value.alias("portfolio_value"))


def buy_hold(df: DataFrame, k, t: str, o: str, c: str, cash: float = CASH, fee: float = FEE) -> DataFrame:
    """Units the starting cash buys at the first opening price, at the last close; 0 counts as 1."""
    ends = df.groupBy(*names(k)).agg(F.min_by(o, t).alias("first_open"), F.max_by(c, t).alias("last_close"))
    units = F.floor(F.try_divide(F.lit(cash * (1 - fee)), F.col("first_open")))
    worth = units * F.col("last_close")
    return ends.withColumn("benchmark", F.when(worth == 0, 1.0).otherwise(worth))


def scores(finals: DataFrame, benchmarks: DataFrame, k) -> DataFrame:
    """Ledger value over benchmark per key."""
    return finals.join(benchmarks, names(k)).withColumn(
        "score", F.try_divide(F.col("final_value"), F.col("benchmark")))


def best_by(df: DataFrame, category: str, score: str, k: str) -> DataFrame:
    """The highest-scoring row of each category, ties by key."""
    first = Window.partitionBy(category).orderBy(F.desc_nulls_last(score), F.asc(k))
    return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def verdict(best: DataFrame, category: str = "category", score: str = "score", goal: float = 1.2) -> DataFrame:
    """Whether both categories' best scores pass the goal, only the index, or neither."""
    def passed(name):
        return F.coalesce(F.max(F.when(F.col(category) == name, F.col(score))) > goal, F.lit(False))
    return best.agg(passed("STOCKS").alias("_stock"), passed("INDICES").alias("_index")).select(
        F.when(F.col("_stock") & F.col("_index"), "both passed")
        .when(F.col("_index"), "index passed").otherwise("not passed").alias("verdict"))


def results(df: DataFrame, label: str = "Target") -> DataFrame:
    """The published columns of a valued position table."""
    return df.select("date", "ticker", "close_price", label, "model_prediction",
                     "strategy_action", "portfolio_value")
