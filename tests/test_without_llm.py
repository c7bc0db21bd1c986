"""The package works without the operators for training data: a copy of the repository lacks them."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
SCRIPT = """
import __spark_entry__ as driver
from slumberline.session import build_session
names = driver.queries()
assert "pipeline" not in names and not any(name.startswith("op") for name in names), sorted(names)
assert set(driver.oracle_sql()) == set(names)
spark = build_session("without", "local[2]", **{"spark.sql.shuffle.partitions": "2"})
rows = names["hour_distribution"](spark, "/root/testdata/sf0.001").count()
spark.stop()
print("rows", rows)
"""


@pytest.mark.parametrize("pipeline_stays", [True, False])
def test_entry_runs_without_the_operators_for_training_data(tmp_path, pipeline_stays):
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache")
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=left_out)
    if not pipeline_stays:
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "rows 24" in done.stdout
