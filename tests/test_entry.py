"""The driver's module without the operators for training data."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]

COUNT = """
import __spark_entry__ as e
names = sorted(e.queries())
assert not [n for n in names if n.startswith("op") or n == "pipeline"], names
assert set(e.oracle_sql()) <= set(names)
print(len(names))
"""


def run(folder, code, **env):
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, env={**os.environ, **env}
    )
    assert done.returncode == 0, done.stderr
    return done.stdout


def copy(tmp_path, *left_out):
    def ignore(folder, names):
        here = Path(folder).relative_to(REPO)
        return [n for n in names if str(here / n) in left_out or n in (".git", "__pycache__")]

    return shutil.copytree(REPO, tmp_path / "copy", ignore=ignore)


def test_the_rest_stands_alone(tmp_path):
    folder = copy(tmp_path, "scorekit/llm", "tests/llm", "corpus_pipeline.py")
    assert int(run(folder, COUNT, PYTHONPATH=str(folder))) >= 29


def test_the_rest_stands_alone_beside_the_pipeline(tmp_path):
    folder = copy(tmp_path, "scorekit/llm", "tests/llm")
    assert int(run(folder, COUNT, PYTHONPATH=str(folder))) >= 29
