"""The entry module works without the optional corpus operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), sorted(set(e.oracle_sql()) - set(e.queries())))"


def _copy(tmp_path, without):
    for name in ("newsflow", "__spark_entry__.py", "corpus_pipeline.py"):
        src = os.path.join(ROOT, name)
        if not os.path.exists(src) or name in without:
            continue
        if os.path.isdir(src):
            skip = [os.path.basename(w) for w in without]
            shutil.copytree(src, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__", *skip))
        else:
            shutil.copy(src, tmp_path / name)


@pytest.mark.parametrize("without", [("newsflow/llm",), ("newsflow/llm", "corpus_pipeline.py")])
def test_entry_imports_without_the_corpus_operators(tmp_path, without):
    _copy(tmp_path, without)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", COUNT], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert got.returncode == 0, got.stderr
    count, orphans = got.stdout.split(" ", 1)
    assert int(count) >= 49 and orphans.strip() == "[]"
