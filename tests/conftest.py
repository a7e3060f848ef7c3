import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from errata.session import local_session

    shared = tmp_path_factory.mktemp("shared")
    session = local_session("4", 4, **{"spark.checkpoint.dir": f"file://{shared}", "spark.sql.warehouse.dir": f"file://{shared}/warehouse", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
