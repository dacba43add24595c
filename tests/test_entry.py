"""The entry module loads in a fresh process with no Spark session, from the
installed pyspark as well as from ``pyspark.zip``."""
import os
import subprocess
import sys

import pyspark
import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ZIP = os.path.join(os.path.dirname(pyspark.__file__), "python", "lib", "pyspark.zip")
CODE = ("import __spark_entry__ as e; q = e.queries(); o = e.oracle_sql(); assert len(q) >= 53 and len(o) >= 50;"
        "from pyspark import SparkContext as S; assert S._active_spark_context is None")


@pytest.mark.parametrize("first", ["", ZIP])
def test_loads_without_session(first):
    if first and not os.path.exists(first):
        pytest.skip("no pyspark.zip here")
    env = os.environ | {"PYTHONPATH": os.pathsep.join(x for x in (first, REPO) if x)}
    subprocess.run([sys.executable, "-c", CODE], cwd=REPO, env=env, check=True, timeout=120)
