import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"

DATA = os.environ.get("LOOMWORK_DATA", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from loomwork.session import build_session

    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "loomwork tests",
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
            "spark.checkpoint.dir": f"{folder}/checkpoints",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA
