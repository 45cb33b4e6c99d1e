import os
import tempfile

import pytest

os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 6g --conf spark.ui.showConsoleProgress=false pyspark-shell")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    base = tempfile.mkdtemp(prefix="flightlake-test-")
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"{base}/work")
        .config("spark.sql.warehouse.dir", f"{base}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows as tuples, sorted."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
