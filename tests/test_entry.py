"""The entry points without the corpus operators."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("left", ["nothing", "empty folder", "pipeline only"])
def test_import_without_corpus_operators(tmp_path, left):
    """With the subpackage gone, or its empty folder left, the other queries are there."""
    for name in ("checks", "rosterline"):
        shutil.copytree(f"{ROOT}/{name}", tmp_path / name,
                        ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    if left == "empty folder":
        (tmp_path / "rosterline" / "llm").mkdir()
    if left == "pipeline only" and os.path.exists(f"{ROOT}/corpus_pipeline.py"):
        shutil.copy(f"{ROOT}/corpus_pipeline.py", tmp_path)
    say = ("import __spark_entry__ as e; q = e.queries(); "
           "print(len(q), sorted(q) == sorted(e.oracle_sql()), 'dim_view' in q)")
    done = subprocess.run([sys.executable, "-c", say], cwd=tmp_path, capture_output=True,
                          text=True, env=os.environ | {"PYTHONPATH": str(tmp_path)}, timeout=120)
    assert done.returncode == 0, done.stderr[-600:]
    count, same, there = done.stdout.split()[-3:]
    assert int(count) > 80 and same == there == "True"
