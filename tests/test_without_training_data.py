"""The feeds work in a copy of the repository that lacks the training-data folders."""

import os
import shutil
import subprocess
import sys

import pytest
from conftest import ROOT

from feedloom.plans import queries as catalog

LEFT_OUT = {
    "folders": (os.path.join("feedloom", "llm"), os.path.join("tests", "llm")),
    "folders and pipeline": (
        os.path.join("feedloom", "llm"), os.path.join("tests", "llm"), "corpus_pipeline.py",
    ),
}


def _copy(target: str, left_out: tuple[str, ...]) -> None:
    def ignored(folder: str, names: list[str]) -> list[str]:
        here = os.path.relpath(folder, ROOT)
        hidden = [n for n in names if n.startswith(".") or n == "__pycache__"]
        return hidden + [n for n in names if os.path.normpath(os.path.join(here, n)) in left_out]

    shutil.copytree(ROOT, target, ignore=ignored)


@pytest.mark.parametrize("kind", sorted(LEFT_OUT))
def test_rest_of_the_repository(tmp_path, kind):
    copy = str(tmp_path / "copy")
    _copy(copy, LEFT_OUT[kind])

    def run(*command: str) -> subprocess.CompletedProcess:
        env = os.environ | {"PYTHONDONTWRITEBYTECODE": "1", "PYTHONPATH": ""}
        return subprocess.run(
            [sys.executable, *command], cwd=copy, env=env, capture_output=True, text=True, timeout=300
        )

    names = run("-c", "import __spark_entry__ as e; print(*sorted(e.queries()))")
    assert names.stdout.split() == sorted(catalog.QUERIES), names.stderr
    collected = run("-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider")
    assert collected.returncode == 0, collected.stdout[-2000:]
