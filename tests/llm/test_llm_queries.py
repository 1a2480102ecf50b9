"""The registered queries against SQL, and the pipeline against its rules."""

from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from ridgeline.llm.queries import QUERIES, SQL
from tests.check import duck, same
from tests.llm.test_decontaminate import brute
from tests.llm.test_dedup import brute_components

FOLDER = "/root/testdata/sf0.001"


def test_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(SQL))
def test_sql(spark, name):
    good, note = same(QUERIES[name](spark, FOLDER), duck(FOLDER), SQL[name])
    assert good, note


def test_near_duplicates(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = QUERIES["op3_near_dedup"](spark, FOLDER).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, 4)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    seen = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, seen, FOLDER).write.parquet(path)
        before, seen = seen, spark.read.parquet(path)
        if name == "shard":
            assert seen.columns == [*docs.columns, "shard", "slot"]
            assert seen.drop("shard", "slot").exceptAll(before).count() == 0 and seen.count() == before.count()
            continue
        assert seen.columns == docs.columns
        rows = [(r.doc_id, r.text) for r in before.collect()]
        left = Counter(r.doc_id for r in seen.collect())
        if name == "near_dedup":
            assert left == Counter({k[2]: 1 for k in brute_components(rows, 5)})
        if name == "decontaminate":
            assert left == Counter(k[0] for k in brute(rows, items).elements() if k[2] == 0)
        if name == "mix":
            assert max(left.values()) <= 3 and set(left) <= {i for i, _ in rows}


def test_run_is_its_stages(spark):
    """``run`` gives what its stages give one after the other."""
    seen = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        seen = stage(spark, seen, FOLDER)
    rows = lambda df: Counter(tuple(r) for r in df.select("doc_id", "shard", "slot", "text", "source").collect())
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns[-2:] == ["shard", "slot"] and rows(got) == rows(seen) and got.count() > 100


def test_stages_of_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, FOLDER)
            assert got.count() <= 3 * docs.count()
            assert got.columns[:len(docs.columns)] == docs.columns
