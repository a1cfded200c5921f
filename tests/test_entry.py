"""The driver contract with and without the training-data operators."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"


def names(folder):
    done = subprocess.run([sys.executable, "-c", NAMES], cwd=folder, capture_output=True, text=True, check=True)
    return [set(line.split()) for line in done.stdout.splitlines()]


@pytest.mark.parametrize("left", ["both", "pipeline", "empty package", "nothing"])
def test_the_rest_imports_without_the_operators(tmp_path, left):
    gone = {"both": (), "pipeline": ("llm",), "empty package": ("llm",), "nothing": ("llm", "corpus_pipeline.py")}[left]
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=lambda _, found: [f for f in found if f in (".git", "__pycache__", *gone)])
    if left == "empty package":
        (copy / "stratagauge" / "llm").mkdir()
    queries, sql = names(copy)
    assert {"target_vs_actual", "quarantine"} <= queries and sql <= queries
    here = left == "both" and os.path.isdir(f"{REPO}/stratagauge/llm")
    assert any(name.startswith("op") for name in queries) == here and ("pipeline" in queries) == here


def test_other_import_errors_are_raised(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm"))
    (copy / "corpus_pipeline.py").write_text("import a_module_that_is_missing\n")
    done = subprocess.run([sys.executable, "-c", NAMES], cwd=copy, capture_output=True, text=True, check=False)
    assert done.returncode and "a_module_that_is_missing" in done.stderr
