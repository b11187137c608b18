import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]").appName("riskloom-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="riskloom-wh-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from riskloom.session import checkpoint_dir
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def seed(spark):
    from tests.seed import seed_mart
    return seed_mart(spark)


@pytest.fixture(scope="session")
def mart(spark):
    from riskloom.plans.registry import get_mart
    return get_mart(spark, SF001)
