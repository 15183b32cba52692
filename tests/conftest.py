import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from alloy.session import get_spark

    s = get_spark("local[4]", app="alloy-tests", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="alloy-test-ckpt-"))
    yield s
    s.stop()


def one(spark, col, value, dtype="string"):
    """Evaluate a Column expression on a one-row frame holding ``value``."""
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(col("x") if callable(col) else col).first()[0]
