import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from wellframe.session import build_session

    folder = tmp_path_factory.mktemp("spark")
    s = build_session(
        "tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": f"file://{folder}/checkpoint", "spark.sql.warehouse.dir": f"{folder}/warehouse"}
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    path = Path("/root/testdata/sf0.001")
    if not path.exists():
        pytest.skip("no test tables")
    return str(path)
