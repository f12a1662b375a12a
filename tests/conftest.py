from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from brooklog.session import session

    shared = tmp_path_factory.mktemp("shared")
    out = session(
        "local[4]", "tests",
        **{"spark.sql.shuffle.partitions": "3", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": str(shared), "spark.sql.warehouse.dir": str(shared / "warehouse"),
           "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.driver.memory": "4g"},
    )
    out.sparkContext.setLogLevel("ERROR")
    yield out
    out.stop()
