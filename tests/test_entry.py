"""The entry point with and without the folders of the operators for training data."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("kept", [(), ("__init__.py",)], ids=["absent", "emptied"])
def test_the_rest_stands_alone(tmp_path, kept):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py", ".pytest_cache"))
    for name in kept:
        (copy / "wardgrid" / "llm").mkdir(exist_ok=True)
        (copy / "wardgrid" / "llm" / name).touch()
    program = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') and n[2].isdigit() for n in q), sorted(q); assert 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", program], cwd=copy, check=True, timeout=120)
    collected = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider"], cwd=copy, capture_output=True, text=True, timeout=120)
    assert collected.returncode == 0, collected.stdout[-2000:]
