import os
import sys
from pathlib import Path

import pytest

HERE = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, HERE)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (HERE, os.environ.get("PYTHONPATH", "")) if x)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from roadflux.session import SETTINGS

    folder = tmp_path_factory.mktemp("spark")
    own = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.sql.warehouse.dir": str(folder / "warehouse"),
        "spark.checkpoint.dir": f"file://{folder}/checkpoints", "spark.sql.autoBroadcastJoinThreshold": "10m",
    }
    session = SparkSession.builder.master("local[4]").config(map=SETTINGS | own).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
