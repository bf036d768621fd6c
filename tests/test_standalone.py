"""The engine without its corpus operators."""

import os
import shutil
import subprocess
import sys

import pytest

from .conftest import ROOT

PROBE = """
import __spark_entry__ as entry
names = set(entry.queries())
assert names and not any(n.startswith("op") and n[2].isdigit() for n in names) and "pipeline" not in names
assert set(entry.oracle_sql()) <= names
"""


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_imports_and_collects_without_corpus_operators(tmp_path, with_pipeline):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache", "spark-warehouse"))
    pipeline = copy / "corpus_pipeline.py"
    if not with_pipeline and pipeline.exists():
        pipeline.unlink()
    env = {**os.environ, "PYTHONPATH": str(copy)}
    for command in (["-c", PROBE], ["-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider"]):
        done = subprocess.run([sys.executable, *command], cwd=copy, env=env, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stdout[-2000:] + done.stderr[-2000:]
