"""The entry point with and without the corpus operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sum(q.startswith('op') for q in e.queries()))"


def _counted(folder):
    done = subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return list(map(int, done.stdout.split()))


def test_the_rest_loads_without_the_corpus_operators(tmp_path):
    from duecast.plans.catalog import ORACLE, QUERIES

    copy = tmp_path / "copy"
    hidden = shutil.ignore_patterns("llm", ".git", "__pycache__", "*.json")
    shutil.copytree(ROOT, copy, ignore=hidden)
    assert (copy / "corpus_pipeline.py").exists() == (ROOT / "corpus_pipeline.py").exists()
    assert _counted(copy) == [len(QUERIES), len(ORACLE), 0]
