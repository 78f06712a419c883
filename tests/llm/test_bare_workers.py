"""Queries run where only the driver has the package."""

import os
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
SF_DIR = "/root/testdata/sf0.001"

SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate())
spark.sparkContext.setLogLevel("OFF")
# The workers inherit the environment and the folder, not this path.
sys.path.insert(0, sys.argv[2])
from chartfold.llm.queries import QUERIES
def alone(rows):
    import importlib.util
    yield importlib.util.find_spec("chartfold") is None
assert spark.sparkContext.parallelize([0], 1).mapPartitions(alone).collect() == [True]
for name in sys.argv[3:]:
    print(name, QUERIES[name](spark, "%s").count())
"""


@pytest.mark.parametrize("names", [("op4_secrets", "op6_language", "op8_shard", "op10_pack"), ("op11_files", "op12_spelling", "op13_divergence")])
def test_queries(names, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(SCRIPT % SF_DIR), str(tmp_path / "shared"), str(ROOT), *names],
        capture_output=True, text=True, cwd=tmp_path, env=env, timeout=400,
    )
    assert run.returncode == 0, run.stderr[-2000:]
    assert [line.split()[0] for line in run.stdout.splitlines() if line.startswith("op")] == list(names)
