"""Workers can import the package wherever the session was started."""

import subprocess
import sys

CODE = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
import __spark_entry__ as e
print("rows", e.queries()["m7_lambda_gradients"](spark, "/root/testdata/sf0.001").count(),
      e.queries()["x4_svd_components"](spark, "/root/testdata/sf0.001").count() > 0)
"""


def test_queries_run_in_a_session_from_elsewhere(tmp_path):
    import os
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE.format(repo=repo)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "rows 6000 True" in out.stdout, out.stderr[-2000:]
