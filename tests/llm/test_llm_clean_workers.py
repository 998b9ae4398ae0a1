"""Queries in a process whose Python workers have no copy of the package."""

import os
import subprocess
import sys

REPOSITORY = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

RUN = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "3").config("spark.ui.enabled", "false").getOrCreate()

def importable(batches):
    import importlib.util
    import pyarrow as pa
    for batch in batches:
        yield pa.record_batch({"found": pa.array([importlib.util.find_spec("gridstats") is not None] * batch.num_rows)})

assert not spark.range(1).mapInArrow(importable, "found boolean").first()[0]
from gridstats.llm.queries import QUERIES
for name in sorted(QUERIES):
    assert len(QUERIES[name](spark, sys.argv[2]).collect()) > 0, name
print("all ran")
"""


def test_queries_run_on_workers_without_the_package(tmp_path, sf_dir):
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", RUN, REPOSITORY, sf_dir], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=900)
    assert "all ran" in done.stdout, done.stderr[-3000:]
