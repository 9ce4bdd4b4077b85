import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def make_session():
    from pyspark.sql import SparkSession

    from voxmill.session import apply_settings

    session = (
        SparkSession.builder.master("local[8]").appName("voxmill-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="voxmill-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return apply_settings(session)


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
