"""The entry without the training-data subpackage: the other queries are all registered."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from hustings.plans import registry

TOP = Path(__file__).resolve().parent.parent
SHOW = "import __spark_entry__ as e; print('\\n'.join(sorted(e.queries()))); print('--'); print('\\n'.join(sorted(e.oracle_sql())))"


@pytest.mark.parametrize("gone", [["hustings/llm"], ["hustings/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_entry_without_parts(tmp_path, gone):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (TOP / name).exists() and name not in gone:
            shutil.copy(TOP / name, tmp_path)
    shutil.copytree(TOP / "hustings", tmp_path / "hustings", ignore=shutil.ignore_patterns("__pycache__", *(["llm"] if "hustings/llm" in gone else [])))
    found = subprocess.run([sys.executable, "-c", SHOW], cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split("--\n")
    queries, oracles = ({line for line in part.splitlines() if line} for part in found)
    assert set(registry.queries()) <= queries and set(registry.oracle_sql()) <= oracles
    assert "pipeline" not in queries
    if "hustings/llm" in gone:
        assert queries == set(registry.queries())


def test_entry_with_another_copy_on_the_path(tmp_path):
    """A part that is gone is not taken from another copy of the repository."""
    shutil.copy(TOP / "__spark_entry__.py", tmp_path)
    shutil.copytree(TOP / "hustings", tmp_path / "hustings", ignore=shutil.ignore_patterns("__pycache__"))
    found = subprocess.run([sys.executable, "-c", SHOW], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(TOP)}, capture_output=True, text=True, check=True)
    queries = set(found.stdout.split("--\n")[0].split())
    assert "pipeline" not in queries and "op8_suffix_dedup" in queries
