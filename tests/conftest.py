import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.checkpoint.dir": f"file://{folder}", "spark.driver.memory": "4g", "spark.sql.warehouse.dir": f"{folder}/warehouse"}
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("no test tables")
    return str(folder)
