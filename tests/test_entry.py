"""The contract holds without the corpus operators, whether or not the pipeline over them is still there."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("left", [["corpus_pipeline.py"], []])
def test_without_the_corpus_operators(tmp_path, left):
    shutil.copytree(f"{ROOT}/tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", *left]:
        if os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 80 and not set(e.oracle_sql()) - set(q); print(*q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    names = said.stdout.split()
    assert "pipeline" not in names and not [n for n in names if n.startswith("op") and n[2:3].isdigit()]
