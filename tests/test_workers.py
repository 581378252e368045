"""Python-worker code must not depend on the package being importable on the workers."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
from metrolens.operators import hull
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
df = spark.createDataFrame([(1, 0.0, 0.0), (1, 1.0, 0.0), (1, 0.0, 1.0), (1, 0.2, 0.2)], "cluster int, x_pixel double, y_pixel double")
print("vertices", hull.cluster_hulls(df).count())
spark.stop()
"""


def test_hulls_run_from_another_working_directory():
    d = tempfile.mkdtemp(prefix="metrolens-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=d, env=env, capture_output=True, text=True, timeout=300)
    assert "vertices 3" in out.stdout, out.stderr[-2000:]
