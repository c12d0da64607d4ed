import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import the package too; on a cluster --py-files does this.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

from txlens.session import STATE_STORE, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "txlens-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
