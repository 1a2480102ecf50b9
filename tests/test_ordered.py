"""Splitting keys into parts must change nothing, whatever the part and bucket sizes."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ridgeline.functions.columns import value_bucket
from ridgeline.operators import ordered as od
from tests.data import START, collected, shuffled, walk

SIZES = {"hot": 700, "mid": 90, "one": 1}


@pytest.mark.parametrize("before,rows,width", [(0, 50, 7), (1, 16, 3), (30, 16, 5), (200, 64, 40), (5, 32, 400)])
def test_parts_hold_every_row_once_and_what_precedes_it(spark, before, rows, width):
    pdf = walk(SIZES)
    parts = od.split(shuffled(spark, pdf), "ticker", "date", before, True, width=width, rows=rows).toPandas()
    home = parts[parts._home]
    assert len(home) == len(pdf) and not home.duplicated(["ticker", "date"]).any()
    if width < 400:
        assert home[home.ticker == "hot"]._part.nunique() > 4
    for key, rows_of in pdf.sort_values("date").groupby("ticker"):
        days = list(rows_of.date)
        place = {d: i for i, d in enumerate(days)}
        for _, part in parts[parts.ticker == key].groupby("_part"):
            own = [place[d] for d in part[part._home].date]
            if not own:
                continue
            have = {place[d] for d in part.date}
            assert not part.duplicated("date").any()
            assert own == list(range(min(own), max(own) + 1)) or sorted(own) == list(range(min(own), max(own) + 1))
            assert set(range(max(0, min(own) - before), min(own))) <= have
            if max(own) + 1 < len(days):
                assert max(own) + 1 in have


def test_buckets_as_wide_as_parts_are_copied_once(spark):
    # Buckets as wide as 10-row parts: each is copied once at most.
    df = spark.range(1_000).select(F.lit("k").alias("ticker"), F.col("id").alias("t"))
    more = spark.range(1_000, 1_020).select(F.lit("k").alias("ticker"), F.col("id").alias("t"))
    parts = od.split(df.union(more), "ticker", "t", before=3, width=1_000, rows=10)
    assert parts.count() <= 2 * 1_020
    assert parts.filter("_home").count() == 1_020


def test_dense_rows_get_narrower_buckets(spark):
    # 20,000 rows of one day for one key, seconds apart, beside a sparse key
    dense = spark.range(20_000).select(F.lit("dense").alias("ticker"), F.timestamp_seconds("id").alias("t"), "id")
    thin = spark.range(50).select(F.lit("thin").alias("ticker"), F.timestamp_seconds(F.col("id") * 86_400).alias("t"), "id")
    parts = od.split(dense.union(thin), "ticker", "t", before=2, rows=1_000)
    sizes = parts.filter("_home").groupBy("ticker", "_part").count().toPandas()
    assert sizes["count"].sum() == 20_050 and sizes["count"].max() <= 3_000
    assert (sizes.ticker == "thin").sum() == 1
    marked = F.when(F.col("id") % 7_000 == 0, F.col("id"))
    out = od.hand_over(dense, "ticker", "t", marked, "seen", width=1_000).filter("seen = id - id % 7000")
    assert out.count() == 20_000


@pytest.mark.parametrize("unit", ["long", "double", "timestamp"])
def test_dense_burst_leaves_other_keys_alone(spark, unit):
    """One key with 400 rows per unit, 20 sparse keys of long range: few buckets, bounded parts, all rows."""
    rows, thin = 1_000, 4_000
    burst = spark.range(40_000).select(F.lit("dense").alias("ticker"), (F.col("id") / 400 if unit == "double" else F.col("id")).alias("t"))
    far = spark.range(20 * thin).select(F.concat(F.lit("thin"), F.col("id") % 20).alias("ticker"),
                                        (F.floor(F.col("id") / 20) * 5_000).alias("t"))
    df = burst.select("ticker", F.col("t").cast("double")).union(far.select("ticker", F.col("t").cast("double")))
    if unit == "timestamp":
        df = df.select("ticker", F.timestamp_micros(F.col("t").cast("long") * F.when(F.col("ticker") == "dense", 3).otherwise(10 ** 9)).alias("t"))
    else:
        df = df.select("ticker", F.col("t").cast(unit).alias("t"))
    _, sizes = od._count(df, ["ticker"], "t", None, rows)
    found = sizes.toPandas()
    assert found._n.sum() == 40_000 + 20 * thin and found._n.max() <= 2 * rows
    assert len(found) <= od.SHORT + 3 * 16 * (40_000 + 20 * thin) / rows
    parts = od.split(df, "ticker", "t", before=2, rows=rows).groupBy("ticker", "_part").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_home").cast("int")).alias("own")).toPandas()
    assert parts.own.sum() == 40_000 + 20 * thin and parts.n.max() <= 5 * rows
    lagged = od.over_series(df, "ticker", "t", 1, lambda d, w: d.withColumn("p", F.lag("t").over(w)), rows=rows)
    assert lagged.filter("p IS NULL").count() == 21 and lagged.count() == 40_000 + 20 * thin


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "long", "double"])
def test_time_types(spark, kind):
    base = spark.range(300).select(F.lit("k").alias("ticker"), (F.col("id") * 40_000).alias("s"), F.col("id").alias("i"))
    if kind == "date":
        df = base.select("ticker", "i", F.date_add(F.lit(START), F.col("i").cast("int")).alias("t"))
    elif kind.startswith("timestamp"):
        df = base.select("ticker", "i", F.timestamp_seconds("s").cast(kind).alias("t"))
    else:
        df = base.select("ticker", "i", (F.col("i") - 150).cast(kind).alias("t"))
    out = od.over_series(df, "ticker", "t", 1, lambda d, w: d.withColumn("p", F.lag("i").over(w)), rows=20,
                         width=None if kind.startswith("t") else 8).toPandas().sort_values("i")
    assert list(out.p.dropna()) == list(range(299))
    assert len(out) == 300


@pytest.mark.parametrize("direction", ["forward", "backward"])
def test_fill_reaches_over_empty_buckets(spark, direction):
    pdf = walk({"a": 400, "b": 50})
    pdf.loc[np.random.default_rng(3).random(len(pdf)) < 0.9, "close_price"] = np.nan
    pdf = pdf.sort_values(["ticker", "date"]).reset_index(drop=True)
    df = shuffled(spark, pdf).withColumn("close_price", F.nanvl("close_price", F.lit(None).cast("double")))
    got = collected(od.fill(df, "ticker", "date", "close_price", "x", direction, width=4))
    grouped = pdf.groupby("ticker").close_price
    want = grouped.ffill() if direction == "forward" else grouped.bfill()
    pd.testing.assert_series_equal(got.x, want, check_names=False)


def test_attach_gives_every_row_its_keys_value(spark):
    pdf = walk(SIZES)
    df = shuffled(spark, pdf)
    counts = df.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))
    out = od.attach(df, counts, "ticker").toPandas()
    assert len(out) == len(pdf) and (out.n == out.ticker.map(SIZES)).all()


def test_value_buckets_keep_the_order(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(0, 1, 3000), 10.0 ** rng.uniform(-300, 300, 1000),
                             -(10.0 ** rng.uniform(-300, 300, 1000)), [0.0, 5e-324, -5e-324, 1.7e308]])
    out = spark.createDataFrame([(float(v),) for v in values], "x double").select(
        "x", value_bucket(F.col("x")).alias("b")).toPandas().sort_values("x")
    assert (np.diff(out.b) >= 0).all() and out.b.nunique() > 4_000


def test_rows_without_key_or_time_are_no_series(spark):
    df = spark.createDataFrame([("a", dt.date(2020, 1, 1), 1.0), (None, dt.date(2020, 1, 1), 2.0), ("a", None, 3.0)],
                               "ticker string, date date, close_price double")
    assert od.merge(od.split(df, "ticker", "date", 1), df).count() == 1


@pytest.mark.parametrize("rows,width", [(od.ROWS, None), (40, 9)])
def test_one_layout_for_several_steps(spark, monkeypatch, rows, width):
    """Rows laid out once give what steps that count for themselves give, also after rows were dropped at the ends."""
    from ridgeline.operators import ledger as lg
    from ridgeline.operators import series as se
    from ridgeline.operators import signals as sg

    monkeypatch.setattr(od, "ROWS", rows)
    monkeypatch.setattr(lg, "ROUND", 2 * rows)
    pdf = walk(SIZES, seed=4)
    pdf = pdf.assign(p=np.random.default_rng(4).random(len(pdf)))
    df = shuffled(spark, pdf)
    stored, laid = od.lay(df, "ticker", "date", width=width, rows=rows)
    assert stored.count() == len(pdf) and laid.total == len(pdf) and (rows > len(pdf) or laid.sizes.count() > 20)
    cut = lambda d: d.filter("date >= date'2000-03-01' and date < date'2002-01-01'")
    rule = (F.col("p") > 0.9, F.col("p") < 0.2)
    one = sg.signal(cut(stored), "ticker", "date", *rule, laid=laid)
    two = sg.signal(cut(df), "ticker", "date", *rule, width=width)
    assert od.BUCKET in one.columns
    pd.testing.assert_frame_equal(collected(one.drop(od.BUCKET)), collected(two))
    a = collected(se.sma(cut(stored), "ticker", "date", "close_price", 30, laid=laid, rows=rows))
    b = collected(se.sma(cut(df), "ticker", "date", "close_price", 30))
    np.testing.assert_allclose(a.SMA_30, b.SMA_30, rtol=1e-12)
    columns = ("ticker", "date", "open_price", "close_price", sg.ACTION)
    one, two = one.persist(), two.persist()
    a, b = lg.ledger_curve(one, *columns, laid=laid), lg.ledger_curve(two, *columns)
    pd.testing.assert_frame_equal(collected(a.drop(od.BUCKET)), collected(b))
    a, b = (lg.ledger_final(d, *columns, **g).orderBy("ticker").toPandas() for d, g in ((one, {"laid": laid}), (two, {})))
    pd.testing.assert_frame_equal(a, b)
    with pytest.raises(ValueError):
        od.split(stored, "p", "date", laid=laid)
