"""Figures of the model queries against plain loops over the table of nodes."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ridgeline.operators import features as ft
from ridgeline.operators import models as md
from ridgeline.operators import trees
from ridgeline.plans import fixtures as fx
from ridgeline.plans import registry as rg
from ridgeline.session import settle, workspace

FOLDER = "/root/testdata/sf0.001"
BOOSTED, FOREST, FIT = md.boosted, md.forest, md.fit
SMALL = {"trees": 4, "depth": 3}


class Asked(Exception):
    pass


@pytest.mark.parametrize("name", ["gbt_scores", "rf_scores", "model_report", "feature_importance", "model_study", "first_strategy", "scan_strategy"])
def test_settings(spark, monkeypatch, tmp_path, name):
    def fit(train, inputs, estimator):
        raise Asked(estimator)

    monkeypatch.setattr(md, "lasting_dir", lambda _: str(tmp_path))
    monkeypatch.setattr(md, "fit", fit)
    with pytest.raises(Asked) as found:
        rg.QUERIES[name](spark, FOLDER)
    e = found.value.args[0]
    if name == "rf_scores":
        assert (e.getNumTrees(), e.getMaxDepth(), e.getMinInstancesPerNode()) == (500, 12, 5)
    elif name == "scan_strategy":
        assert (e.getMaxIter(), e.getMaxDepth(), e.getStepSize(), e.getSubsamplingRate()) == (400, 6, 0.02, 0.85)
    else:
        assert (e.getMaxIter(), e.getMaxDepth(), e.getStepSize(), e.getSubsamplingRate()) == (300, 6, 0.03, 0.8)


@pytest.mark.parametrize("name", ["model_study", "rf_scores", "first_strategy", "scan_strategy"])
def test_orders_are_read_once(spark, monkeypatch, tmp_path, name):
    """All that grows with the orders is done once: the steps before the fit read stored prices."""
    days = spark.range(1200).selectExpr("id AS o_orderkey", "timestamp_ntz'1995-01-01' + make_dt_interval(cast(id DIV 3 AS int)) AS o_orderdate",
                                        "concat(element_at(array('1', '4'), cast(id % 2 + 1 AS int)), '-x') AS o_orderpriority",
                                        "cast(100000 + pmod(id * 7919, 1009) * 50 AS double) AS o_totalprice")
    days.write.parquet(f"{tmp_path}/orders.parquet")
    seen = spark.sparkContext.accumulator(0)

    def counted(key):
        seen.add(1)
        return key

    def fit(train, inputs, estimator):
        raise Asked(train.count())

    monkeypatch.setattr(fx, "table", lambda s, folder, of: s.read.parquet(f"{folder}/{of}.parquet").withColumn(
        "o_orderkey", F.udf(counted, "long")("o_orderkey")))
    monkeypatch.setattr(md, "lasting_dir", lambda _: str(tmp_path / "models"))
    monkeypatch.setattr(md, "fit", fit)
    with pytest.raises(Asked) as found:
        rg.QUERIES[name](spark, str(tmp_path))
    assert found.value.args[0] > 0 and seen.value == 1200


@pytest.fixture
def small(monkeypatch, tmp_path):
    """Small trees in a store of their own; what was fitted."""
    fitted = []

    def fit(train, inputs, estimator):
        fitted.append(type(estimator).__name__)
        return FIT(train, inputs, estimator)

    monkeypatch.setattr(md, "lasting_dir", lambda _: str(tmp_path / "models"))
    monkeypatch.setattr(md, "fit", fit)
    monkeypatch.setattr(md, "boosted", lambda *label, **given: BOOSTED(*label, **{**given, **SMALL}))
    monkeypatch.setattr(md, "forest", lambda *label, **given: FOREST(*label, **{**given, **SMALL}))
    return fitted


def walked(all_nodes, row):
    """Per tree: its weight and the value of the leaf the row ends in."""
    for tree, nodes in all_nodes.items():
        at = nodes[0]
        while at.feature:
            at = nodes[at.left if row[at.feature] <= at.threshold else at.right]
        yield at.weight, at.value


def chance(all_nodes, row, kind):
    found = list(walked(all_nodes, row))
    if kind == trees.BOOSTED:
        return 1 / (1 + math.exp(-2 * sum(w * v for w, v in found)))
    return sum(v for _, v in found) / len(found)


@pytest.fixture(scope="module")
def table(spark):
    rows = settle(ft.date_split(ft.features(fx.prices(spark, FOLDER)), "date", fx.PERIODS))
    return rows, [c for c in ft.input_columns(rows) if c != "split"]


def models(folder):
    return [str(p) for p in folder.iterdir() if p.name.startswith("model-")]


@pytest.mark.parametrize("name,kind", [("gbt_scores", trees.BOOSTED), ("rf_scores", trees.FOREST)])
def test_scores_are_those_of_the_nodes(spark, small, tmp_path, table, name, kind):
    got = rg.QUERIES[name](spark, FOLDER).collect()
    rows, inputs = table
    path, = models(tmp_path / "models")
    assert trees.kind(spark, path) == kind
    all_nodes = defaultdict(dict)
    for r in trees.nodes(spark, path, inputs).collect():
        all_nodes[r.tree][r.node] = r
    assert len(all_nodes) == SMALL["trees"] and any(len(n) > 3 for n in all_nodes.values())
    by_key = {(r.ticker, str(r.date)): r for r in rows.filter("split <> 'train'").collect()}
    assert len(got) == len(by_key) and small == [{"gbt_scores": "GBTClassifier", "rf_scores": "RandomForestClassifier"}[name]]
    for r in got:
        p = chance(all_nodes, by_key[r.ticker, r.date], kind)
        assert r.p == pytest.approx(p, abs=1e-8) and r.predicted == (p > 0.5) and r.split != "train"
    # Gains and counts of splits.
    gain, splits = Counter(), Counter()
    for nodes in all_nodes.values():
        of_tree = Counter()
        for n in nodes.values():
            if n.feature:
                of_tree[n.feature] += n.gain * n["count"]
                splits[n.feature] += 1
        whole = sum(of_tree.values()) if kind == trees.FOREST else 1
        gain.update({f: g / whole for f, g in of_tree.items()})
    found = {r.feature: r for r in trees.importance(spark, path, inputs).collect()}
    whole = sum(gain.values())
    own = md.load(path).stages[-1].featureImportances.toArray()
    assert list(found) and set(found) == set(inputs)
    for i, f in enumerate(inputs):
        assert found[f].splits == splits[f] and found[f].importance == pytest.approx(gain[f] / whole, abs=1e-12) == pytest.approx(own[i], abs=1e-12)
    order = sorted(inputs, key=lambda f: (-splits[f], f))
    assert [found[f].place for f in order] == list(range(1, len(inputs) + 1))


def test_one_fit_for_all(spark, small, tmp_path):
    """Four queries and the first strategy ask for the same trees: fitted once, also where a workspace ends in between."""
    with workspace(spark):
        scores = {(r.ticker, r.date): r for r in rg.QUERIES["gbt_scores"](spark, FOLDER).collect()}
    with workspace(spark):
        report = {r["class"]: r for r in rg.QUERIES["model_report"](spark, FOLDER).collect()}
    with workspace(spark):
        leading = {r.place: r for r in rg.QUERIES["feature_importance"](spark, FOLDER).collect()}
    with workspace(spark):
        whole = rg.QUERIES["model_study"](spark, FOLDER).collect()
    with workspace(spark):
        first = rg.QUERIES["first_strategy"](spark, FOLDER).collect()
    assert small == ["GBTClassifier"] and len(models(tmp_path / "models")) == 1
    test = [r for r in scores.values() if r.split == "test"]
    right = sum(r.predicted == r.Target for r in test)
    assert report["accuracy"].f1 == pytest.approx(right / len(test), abs=1e-8) and report["0"].support + report["1"].support == len(test)
    hit = sum(r.predicted == r.Target == 1 for r in test)
    assert report["1"].precision == pytest.approx(hit / max(sum(r.predicted for r in test), 1), abs=1e-8)
    assert report["1"].recall == pytest.approx(hit / sum(r.Target for r in test), abs=1e-8)
    pairs = [(a.p > b.p) + (a.p == b.p) / 2 for a in test for b in test if a.Target > b.Target]
    assert report["auc"].auc == pytest.approx(sum(pairs) / len(pairs), abs=1e-8)
    assert sorted(leading) == list(range(1, 16)) and leading[1].splits >= leading[2].splits > 0
    parts = defaultdict(list)
    for r in whole:
        parts[r.part].append(r)
    assert {(r.ticker, r.date, r.p, r.predicted) for r in parts["scores"]} == {(*k, r.p, r.predicted) for k, r in scores.items()}
    assert {(r["class"], r.f1, r.auc) for r in parts["report"]} == {(k, r.f1, r.auc) for k, r in report.items()}
    assert {(r.place, r.feature, r.splits, r.importance) for r in parts["importance"]} == {(k, r.feature, r.splits, r.importance) for k, r in leading.items()}
    ranked = [r for r in first if r.part == "ranking"]
    ends = {}
    for r in sorted((r for r in first if r.part == "results"), key=lambda r: r.date):
        ends[r.ticker] = r.portfolio_value
    assert {r.ticker: r.final_value for r in ranked} == pytest.approx(ends)
    assert set(ends) == {r.ticker for r in scores.values() if r.split == "prediction"}


def test_scan_strategy(spark, small):
    """The forest speaks for stocks, the boosted trees for indices."""
    got = rg.QUERIES["scan_strategy"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(small) == ["GBTClassifier", "RandomForestClassifier"]
    ranked = {r.ticker: r for r in got if r.part == "ranking"}
    assert {k: r.category for k, r in ranked.items()} == {"S1": "STOCKS", "S2": "STOCKS", "S3": "STOCKS", "^I4": "INDICES", "^I5": "INDICES"}
    assert all(r.score == pytest.approx(r.final_value / r.benchmark, abs=1e-6) for r in ranked.values())


def test_stored_by_table_and_settings(spark, small, tmp_path, table):
    """Another order or layout of the rows finds the same model; other rows or settings get their own."""
    rows, inputs = table
    train = md.weigh_positive(rows.filter("split = 'train'"), "Target", 1.2)
    one = md.stored_fit(train, inputs, md.boosted())
    assert md.stored_fit(train.repartition(7), inputs, md.boosted()) == one and len(small) == 1
    again = str(tmp_path / "again")
    md.fit(train.repartition(5).repartition(1, *inputs, "_weight", "Target").sortWithinPartitions(*inputs, "_weight", "Target"), inputs, md.boosted()).save(again)
    key = lambda path: sorted(map(str, trees.nodes(spark, path, inputs).drop("weight").collect()))
    assert key(one) == key(again)
    assert md.stored_fit(train.filter("ticker <> '^I4'"), inputs, md.boosted()) != one
    assert md.stored_fit(train, inputs, BOOSTED(trees=3, depth=2)) != one and len(models(tmp_path / "models")) == 3
