import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import get_session

    shared = tmp_path_factory.mktemp("shared")
    session = get_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.checkpoint.dir": f"file://{shared}", "spark.driver.host": "127.0.0.1", "spark.sql.warehouse.dir": f"file://{shared}/warehouse"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
