import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from pitchline.session import DEFAULT_CONF, drop_intermediates
    b = (SparkSession.builder.master("local[*]").appName("pitchline-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="pl-test-ckpt-", dir="/tmp")))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    drop_intermediates(s)
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="pl-test-", dir="/tmp")
