import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from civicmart.session import build_session, shared_dir
    s = build_session("civicmart-tests", master="local[4]",
                      conf={"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    shared_dir(s)  # registers a checkpoint folder only if the session has none
    yield s


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
