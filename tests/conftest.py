import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from millrace.session import build_session

    d = tmp_path_factory.mktemp("spark")
    s = build_session("tests", "local[4]", 4, **{"spark.sql.warehouse.dir": str(d / "warehouse"), "spark.checkpoint.dir": str(d / "checkpoints"), "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
