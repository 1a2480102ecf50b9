"""The library without its optional part."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LOOK = """
import __spark_entry__ as entry
names = set(entry.queries())
assert "trip_stats" in names and "pipeline" not in names and not [n for n in names if n.startswith("op")], names
assert set(entry.oracle_sql()) <= names
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_the_operators_for_training_data(tmp_path, pipeline):
    """Their folders are gone; the file of the pipeline may have stayed behind."""
    copy = str(tmp_path / "copy")
    gone = ["llm", ".git", "__pycache__", ".pytest_cache", *([] if pipeline else ["corpus_pipeline.py"])]
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(*gone))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    for command in (["-c", LOOK], ["-m", "pytest", "--collect-only", "-q", "tests"]):
        done = subprocess.run([sys.executable, *command], cwd=copy, env=env, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stdout + done.stderr
