import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[4]").appName("corvid-tests")
             .config("spark.sql.shuffle.partitions", "4")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from corvid.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    yield spark


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="corvid-test-")
