"""Queries whose workers cannot import the library."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
RUN = """
import os, sys
sys.path.insert(0, {repo!r})
import corpus_pipeline
from ridgeline.llm.queries import QUERIES
from ridgeline.session import build_session

spark = build_session("workers", "local[4]", **{{"spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": os.getcwd() + "/shared"}})
spark.sparkContext.setLogLevel("ERROR")

def here(_):
    try:
        import ridgeline
    except ModuleNotFoundError:
        return ["no"]
    return ["yes"]

assert spark.sparkContext.parallelize([0], 1).flatMap(here).collect() == ["no"]
folder = "/root/testdata/sf0.001"
docs = spark.read.parquet(folder + "/documents.parquet")
assert corpus_pipeline.language(spark, docs, folder).count() > 100
for name in {names!r}:
    assert QUERIES[name](spark, folder).count() > 0, name
print("all ran")
"""


def test_workers_without_the_package(tmp_path):
    from ridgeline.llm.queries import QUERIES

    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = RUN.format(repo=REPO, names=list(QUERIES))
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert "all ran" in done.stdout, done.stdout + done.stderr[-3000:]
