"""A plain local session without any setting runs operators that keep intermediate tables."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


def test_near_duplicates_on_a_stock_session(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
from regspan.llm.queries import QUERIES
print("rows", QUERIES["op4_minhash"](spark, {SF!r}).count())
"""
    (tmp_path / "conf").mkdir()
    env = dict(os.environ) | {"SPARK_CONF_DIR": str(tmp_path / "conf")}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.split()[1]) == 200
