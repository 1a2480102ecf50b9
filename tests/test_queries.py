"""Every registered query against its SQL counterpart on the given tables."""

import pytest

import __spark_entry__ as entry
from ridgeline.plans.oracles import ORACLES
from ridgeline.plans.registry import QUERIES
from tests.check import duck, same

FOLDER = "/root/testdata/sf0.01"
SQL = ORACLES
# Trees have no SQL; ``test_model_queries`` holds their figures against loops.
FITTED = {"gbt_scores", "rf_scores", "model_report", "feature_importance", "model_study", "first_strategy", "scan_strategy"}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_names():
    assert set(SQL) == set(QUERIES) - FITTED and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, con, name):
    good, note = same(entry.queries()[name](spark, FOLDER), con, SQL[name])
    assert good, note


def test_entry(spark):
    assert entry.entry(spark).count() == 24


def test_workspace_goes_with_its_tables(spark, tmp_path):
    from pathlib import Path

    from ridgeline.session import settle, workspace

    with workspace(spark) as folder:
        assert settle(spark.range(3)).count() == 3
        with workspace(spark) as inner:
            settle(spark.range(2))
            assert inner.startswith(folder) and list(Path(inner).iterdir())
        assert not Path(inner).exists() and list(Path(folder).iterdir())
    assert not Path(folder).exists()
