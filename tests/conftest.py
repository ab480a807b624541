import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("scratch")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .config("spark.checkpoint.dir", str(scratch / "checkpoint"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    from ledgerloom.deploy import ship_package

    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    """Oracle scale: the smallest by default, another by LEDGERLOOM_SF."""
    return f"/root/testdata/sf{os.environ.get('LEDGERLOOM_SF', '0.001')}"
