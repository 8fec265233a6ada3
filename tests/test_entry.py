"""The entry file without the subpackage of the training-data operators."""

import pathlib
import shutil
import subprocess
import sys

from qloom.plans import ORACLES, QUERIES

ROOT = pathlib.Path(__file__).resolve().parent.parent


def test_other_queries_stay_without_the_training_data_operators(tmp_path):
    shutil.copytree(ROOT / "qloom", tmp_path / "qloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path / name)
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(%r), sorted(e.oracle_sql()) == sorted(%r))"
    run = subprocess.run(
        [sys.executable, "-c", code % (list(QUERIES), list(ORACLES))], cwd=tmp_path, capture_output=True, text=True, timeout=120
    )
    assert run.stdout.split() == ["True", "True"], run.stderr
