import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ridgeline.functions import columns
from ridgeline.operators import metrics as mt
from ridgeline.operators import stats as st
from tests.data import collected, shuffled, walk

KEY = ("ticker", "date", "close_price")


@pytest.mark.parametrize("slice_rows", [None, 20])
def test_describe_matches_pandas(spark, slice_rows, monkeypatch):
    if slice_rows:
        monkeypatch.setattr(columns, "CELL_VALUES", slice_rows)
    rng = np.random.default_rng(0)
    pdf = pd.concat([
        pd.DataFrame({"ticker": "heavy", "x": np.concatenate([np.full(700, 5.0), rng.normal(0, 1, 300)])}),
        pd.DataFrame({"ticker": "tails", "x": 10.0 ** rng.uniform(-9, 9, 501) * rng.choice([-1, 1], 501)}),
        pd.DataFrame({"ticker": "two", "x": [1.0, 4.0]}), pd.DataFrame({"ticker": "one", "x": [3.0]}),
        # Values of narrow relative spread, as stamps of one day are, share a bucket or two.
        pd.DataFrame({"ticker": "narrow", "x": 1.7e18 + rng.permutation(4000) * 1e6}),
        pd.DataFrame({"ticker": "holes", "x": [1.0, np.nan, 2.0, np.nan, 9.0]})])
    got = st.describe_by(shuffled(spark, pdf), "ticker", "x").toPandas().set_index("ticker").sort_index()
    want = pdf.groupby("ticker").x.describe().sort_index()
    # Around 10 ** 18 a double has no digits left for a deviation of 10 ** 9 to compare.
    assert got.loc["narrow", "std"] == pytest.approx(want.loc["narrow", "std"], rel=1e-5)
    got.loc["narrow", "std"] = want.loc["narrow", "std"]
    np.testing.assert_allclose(got.to_numpy(float), want.to_numpy(float), rtol=1e-9, atol=1e-12)


def test_describe_of_a_key_without_values(spark):
    got = st.describe_by(spark.sql("select 'a' as ticker, cast(null as double) as x"), "ticker", "x").first()
    assert got["count"] == 0 and got.p50 is None and got["mean"] is None


@pytest.mark.parametrize("fill", [None, "ffill"])
def test_correlations_match_pandas(spark, fill):
    pdf = walk({"A": 400, "B": 380, "C": 30, "D": 2, "E": 200}, seed=11, gap=0.8)
    keys = ["A", "B", "C", "D"]
    got = st.corr_matrix(shuffled(spark, pdf), *KEY, keys=keys, fill=fill).toPandas()
    assert len(got) == 6
    if fill:
        table = pdf.pivot_table(index="date", columns="ticker", values="close_price").ffill().pct_change(fill_method=None)
    else:
        pdf = pdf.sort_values("date")
        table = pdf.assign(r=pdf.groupby("ticker").close_price.pct_change()).pivot_table(
            index="date", columns="ticker", values="r")
    for r in got.itertuples():
        both = table[[r.key_a, r.key_b]].dropna()
        assert r.n == len(both)
        want = table[r.key_a].corr(table[r.key_b])
        assert (np.isnan(want) or r.n < 2) if np.isnan(r.corr) else r.corr == pytest.approx(want, abs=1e-12)


def test_no_join_of_a_key_with_itself(spark):
    plan = st.corr_matrix(shuffled(spark, walk({"A": 9, "B": 9})), *KEY, keys=["A", "B"])._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_pivot_takes_the_mean(spark):
    df = spark.sql("select * from values (1,'a',1d),(1,'a',3d),(1,'b',5d),(2,'b',7d),(2,'z',9d) as v(date,ticker,x)")
    assert [tuple(r) for r in st.pivot_by(df, "date", "ticker", ["a", "b"], "x").orderBy("date").collect()] == [
        (1, 2.0, 5.0), (2, None, 7.0)]


def test_density(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 0.03, 300), np.zeros(200)])
    pdf = pd.concat([pd.DataFrame({"ticker": "a", "x": x}), pd.DataFrame({"ticker": "flat", "x": np.ones(5)})])
    got = collected(st.kde(shuffled(spark, pdf), "ticker", "x", points=11), ["point"])
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(-0.1, 0.1, 11)
    want = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).mean(1) / (h * np.sqrt(2 * np.pi))
    np.testing.assert_allclose(got[got.ticker == "a"].density, want, rtol=1e-10)
    # Values without spread have no density.
    assert len(got) == 22 and got[got.ticker == "flat"].density.isna().all()


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(6)
    label = rng.integers(0, 2, 3000)
    score = np.where(rng.random(3000) < 0.3, 0.5, rng.random(3000) * 0.5 + label * 0.3 - 0.2)
    pdf = pd.DataFrame({"label": label, "score": score, "pred": (score > 0.4).astype(int)})
    return pdf, shuffled(spark, pdf)


def test_auc_and_curve(scored):
    pdf, df = scored
    pos, neg = (pdf[pdf.label == i].score.to_numpy() for i in (1, 0))
    wins = (pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean()
    auc = mt.roc_auc(df, "label", "score").first().auc
    assert auc == pytest.approx(wins, abs=1e-12)
    down = mt.roc_auc(df.withColumn("score", -F.col("score")), "label", "score").first().auc
    assert auc + down == pytest.approx(1.0, abs=1e-12)
    curve = collected(mt.roc_curve(df, "label", "score"), ["threshold"])
    assert len(curve) == pdf.score.nunique()
    for r in curve.iloc[::97].itertuples():
        assert r.tpr == pytest.approx((pos >= r.threshold).mean()) and r.fpr == pytest.approx((neg >= r.threshold).mean())


@pytest.mark.parametrize("slice_rows", [None, 50])
def test_curve_of_narrow_and_missing_scores(spark, slice_rows, monkeypatch):
    """Scores that share a bucket are cut into slices; NULL and NaN are no scores."""
    if slice_rows:
        monkeypatch.setattr(columns, "CELL_VALUES", slice_rows)
    rng = np.random.default_rng(7)
    score = np.concatenate([1e9 + rng.permutation(1500), rng.normal(0, 1, 500), np.full(100, -3.0)])
    label = rng.integers(0, 2, len(score))
    df = shuffled(spark, pd.DataFrame({"label": label, "score": score}))
    extra = spark.createDataFrame([(1, float("nan")), (0, None), (1, None)], "label long, score double")
    whole = df.select(F.col("label").cast("long"), "score").union(extra)
    curve = collected(mt.roc_curve(whole, "label", "score"), ["threshold"])
    pos, neg = score[label == 1], score[label == 0]
    assert len(curve) == len(np.unique(score))
    np.testing.assert_allclose(curve.tpr, [(pos >= t).mean() for t in curve.threshold])
    np.testing.assert_allclose(curve.fpr, [(neg >= t).mean() for t in curve.threshold])
    wins = (pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean()
    assert mt.roc_auc(whole, "label", "score").first().auc == pytest.approx(wins, abs=1e-12)


def test_correlation_leaves_out_nan(spark):
    from ridgeline.functions.columns import pearson

    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.5), (3.0, 5.0), (float("nan"), 1.0), (4.0, None)], "x double, y double")
    assert df.agg(pearson(F.col("x"), F.col("y"))).first()[0] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.5, 5])[0, 1])


def test_ready_changes_are_taken_as_they_are(spark):
    pdf = walk({"A": 200, "B": 180}, seed=3, gap=0.8).assign(r=lambda d: np.random.default_rng(4).normal(size=len(d)))
    got = st.corr_matrix(shuffled(spark, pdf), "ticker", "date", "r", ["A", "B"], ready=True).first()
    both = pdf.pivot(index="date", columns="ticker", values="r").dropna()
    assert got.n == len(both) and got["corr"] == pytest.approx(both.A.corr(both.B), abs=1e-12)


def test_report(spark, scored):
    pdf, df = scored
    cells = {(r.label, r.pred): r.n for r in mt.confusion(df, "label", "pred").collect()}
    assert cells == pdf.groupby(["label", "pred"]).size().to_dict()
    lines = {r["class"]: r for r in mt.class_report(df, "label", "pred").collect()}
    tp, fp, fn = cells[1, 1], cells[0, 1], cells[1, 0]
    assert lines["1"].precision == pytest.approx(tp / (tp + fp)) and lines["1"].recall == pytest.approx(tp / (tp + fn))
    assert lines["1"].f1 == pytest.approx(2 * tp / (2 * tp + fp + fn)) and lines["1"].support == tp + fn
    assert lines["accuracy"].f1 == pytest.approx((pdf.label == pdf.pred).mean())
    assert lines["weighted avg"].recall == pytest.approx(lines["accuracy"].recall)
    never = spark.createDataFrame([(0, 0), (1, 0)], "label int, pred int")
    lines = {r["class"]: r for r in mt.class_report(never, "label", "pred").collect()}
    assert (lines["1"].precision, lines["1"].recall, lines["1"].f1) == (0.0, 0.0, 0.0)
    assert mt.confusion(never, "label", "pred").count() == 4


@pytest.mark.parametrize("fill", [None, "ffill"])
def test_correlations_in_tiles(spark, fill, monkeypatch):
    """Blocks smaller than the list of keys, and few times a task, give the same matrix; no column per key."""
    monkeypatch.setattr(st, "TILE", 3)
    monkeypatch.setattr(st, "TILE_TIMES", 40)
    pdf = walk({f"K{i}": 60 + 20 * i for i in range(8)}, seed=3, gap=0.6)
    keys = [f"K{i}" for i in (6, 1, 0, 3, 7, 2, 9)]  # in any order; one has no rows, two are not listed
    df = shuffled(spark, pdf)
    got = {(r.key_a, r.key_b): r for r in st.corr_matrix(df, *KEY, keys=keys, fill=fill).collect()}
    table = pdf.pivot_table(index="date", columns="ticker", values="close_price")
    table = table.ffill().pct_change(fill_method=None) if fill else pd.DataFrame(
        {k: g.sort_values("date").set_index("date").close_price.pct_change() for k, g in pdf.groupby("ticker")}).reindex(table.index)
    some = [k for k in keys if k != "K9"]
    for i, a in enumerate(some):
        for b in some[i + 1:]:
            both = table[[a, b]].dropna()
            assert got[a, b].n == len(both) and got[a, b]["corr"] == pytest.approx(both[a].corr(both[b]), abs=1e-12)
    # The same over numbers and timestamps as times.
    for kind in ("bigint", "timestamp"):
        other = df.withColumn("date", F.unix_date("date").cast("bigint") if kind == "bigint" else F.col("date").cast("timestamp"))
        again = {(r.key_a, r.key_b): (r.n, r["corr"]) for r in st.corr_matrix(other, *KEY, keys=keys, fill=fill).collect()}
        assert {k: v[0] for k, v in again.items()} == {k: r.n for k, r in got.items()}
        assert all(v[1] is None and got[k]["corr"] is None or v[1] == pytest.approx(got[k]["corr"], abs=1e-12) for k, v in again.items())
    plan = st.corr_matrix(df, *KEY, keys=keys, fill=fill)._jdf.queryExecution().optimizedPlan().toString()
    assert "pivot" not in plan.lower()


def test_correlations_of_many_keys(spark):
    """Six hundred keys: a task holds two blocks of 128 and no more."""
    keys, days = 600, 30
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"ticker": np.repeat([f"k{i}" for i in range(keys)], days),
                        "date": np.tile(pd.date_range("2020-01-01", periods=days).date, keys), "close_price": rng.normal(0, 1, keys * days)})
    names = [f"k{i}" for i in range(keys)]
    found = st.corr_matrix(spark.createDataFrame(pdf), *KEY, keys=names, ready=True).toPandas()
    want = np.corrcoef(pdf.close_price.to_numpy().reshape(keys, days))
    assert len(found) == keys * (keys - 1) // 2 and (found.n == days).all()
    np.testing.assert_allclose(found["corr"], want[found.key_a.str[1:].astype(int), found.key_b.str[1:].astype(int)], atol=1e-10)
