import os
import subprocess
import sys

SCRIPT = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from readmill import session
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert session.materialise(spark.range(5), "five").count() == 5
assert session.checkpoint_dir(spark) == session.checkpoint_dir(spark.newSession())
spark.stop()
"""


def test_a_local_session_without_a_shared_folder_works(tmp_path):
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # An empty folder of settings, so that no default names a shared folder.
    environment = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": home}
    done = subprocess.run([sys.executable, "-c", SCRIPT], env=environment, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
