import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

REPO = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, REPO)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [REPO, os.environ.get("PYTHONPATH")]))  # for Python workers


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    tmp = tmp_path_factory.mktemp("spark")
    builder = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
    builder = builder.config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", str(tmp / "checkpoint"))
    session = builder.config("spark.local.dir", str(tmp / "local")).config("spark.sql.warehouse.dir", str(tmp / "warehouse")).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
