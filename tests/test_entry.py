"""The entry points where the training-data folders are not there."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAY = """
import __spark_entry__ as e
from siftline.plans import catalog
assert set(e.queries()) == set(catalog.QUERIES), set(e.queries()) ^ set(catalog.QUERIES)
assert set(e.oracle_sql()) == set(catalog.ORACLE_SQL)
"""


def without(tmp_path, *gone: str) -> subprocess.CompletedProcess:
    copy = shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "__pycache__", *gone))
    env = {**os.environ, "PYTHONPATH": str(copy)}
    return subprocess.run([sys.executable, "-c", SAY], cwd=copy, env=env, capture_output=True, text=True, timeout=300)


def test_queries_without_the_folders_but_with_the_pipeline(tmp_path):
    done = without(tmp_path, "llm")
    assert done.returncode == 0, done.stderr


def test_queries_without_folders_and_pipeline(tmp_path):
    done = without(tmp_path, "llm", "corpus_pipeline.py")
    assert done.returncode == 0, done.stderr


def test_an_error_inside_the_pipeline_is_not_swallowed(tmp_path):
    copy = shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "__pycache__"))
    (copy / "corpus_pipeline.py").write_text("import a_module_that_nobody_has\n")
    env = {**os.environ, "PYTHONPATH": str(copy)}
    if not (copy / "siftline" / "llm").exists():
        return
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; e.queries()"], cwd=copy, env=env, capture_output=True, text=True, timeout=300)
    assert "a_module_that_nobody_has" in done.stderr
