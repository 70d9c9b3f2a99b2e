"""The shared folder in a session that names none."""
import os
import subprocess
import sys

SCRIPT = """
from pyspark.sql import SparkSession
from cohortqc.session import shared_folder
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
one, two = shared_folder(spark, "a"), shared_folder(spark, "a")
assert one != two and one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0]
spark.range(3).write.parquet(one)
assert spark.read.parquet(one).count() == 3
"""


def test_local_session_without_a_shared_folder(tmp_path):
    """Core settings cannot be changed in a running session, so none is."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": root}
    run = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr[-2000:]
