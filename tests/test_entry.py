"""The driver's entry file, with and without the corpus operators."""

import os
import shutil
import subprocess
import sys

import pytest

from conftest import ROOT

COUNT = """
import __spark_entry__ as e
from gamestats.plans.catalog import star_queries
q, sql = e.queries(), e.oracle_sql()
assert set(star_queries()) <= set(q) and set(star_queries()) <= set(sql)
print(sorted(set(q) - set(star_queries())))
"""


def _copy(tmp_path, without):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in without and os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", tmp_path / name)
    shutil.copytree(f"{ROOT}/gamestats", tmp_path / "gamestats", ignore=lambda folder, names: [
        n for n in names if n in without or n == "__pycache__"])


def _load(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", COUNT], cwd=tmp_path, env=env,
                          capture_output=True, text=True)


@pytest.mark.parametrize("without", [{"llm"}, {"llm", "corpus_pipeline.py"}])
def test_the_library_loads_without_the_corpus_operators(tmp_path, without):
    _copy(tmp_path, without)
    run = _load(tmp_path)
    assert run.returncode == 0, run.stderr
    assert run.stdout.strip() == "[]"


@pytest.mark.skipif(not os.path.exists(f"{ROOT}/gamestats/llm"), reason="left out")
def test_a_fault_inside_the_corpus_operators_is_raised(tmp_path):
    _copy(tmp_path, set())
    with open(tmp_path / "gamestats" / "llm" / "queries.py", "a") as out:
        out.write("\nimport a_module_that_is_not_there\n")
    run = _load(tmp_path)
    assert run.returncode != 0 and "a_module_that_is_not_there" in run.stderr
