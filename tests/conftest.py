import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from ragloom.session import LOCAL_DEFAULTS, ensure_checkpoint_dir
    b = SparkSession.builder.master("local[*]").appName("ragloom-tests")
    for k, v in LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", "8")
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ragloom-test-ckpt-"))
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="ragloom-test-")


@pytest.fixture(scope="session")
def spark_session_for_hypothesis(spark):
    """The session fixture under a name hypothesis-decorated tests can use."""
    return spark
