import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]
os.environ["PYTHONPATH"] = os.pathsep.join([os.path.dirname(HERE), HERE, os.environ.get("PYTHONPATH", "")])  # for the workers


@pytest.fixture(scope="session")
def spark():
    with tempfile.TemporaryDirectory() as folder:
        session = (
            SparkSession.builder.master("local[8]")
            .config("spark.sql.shuffle.partitions", "4")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.driver.memory", "6g")
            .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
            .config("spark.checkpoint.dir", f"file://{folder}/shared")
            .getOrCreate()
        )
        session.sparkContext.setLogLevel("ERROR")
        yield session
        session.stop()
