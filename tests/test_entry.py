"""The driver's entry point with and without the training-data package."""

from __future__ import annotations

import json
import os
import pathlib
import shutil
import subprocess
import sys

import pytest

REPO = pathlib.Path(__file__).resolve().parents[1]
LIST = "import json, __spark_entry__ as e; print(json.dumps(sorted(e.queries())))"


def names(folder) -> set[str]:
    found = subprocess.run([sys.executable, "-c", LIST], cwd=folder, env={**os.environ, "PYTHONPATH": str(folder)}, capture_output=True, text=True)
    assert found.returncode == 0, found.stderr
    return set(json.loads(found.stdout))


@pytest.mark.parametrize("pipeline", [True, False])
def test_imports_without_the_training_data_package(tmp_path, pipeline):
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    if pipeline and (REPO / "corpus_pipeline.py").exists():
        shutil.copy(REPO / "corpus_pipeline.py", tmp_path)
    shutil.copytree(REPO / "spendlake", tmp_path / "spendlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    from spendlake.queries import cleaning, loading, resolving

    assert names(tmp_path) == {*cleaning.QUERIES, *loading.QUERIES, *resolving.QUERIES}
    assert len(names(tmp_path)) >= 90
