from __future__ import annotations

import os
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from ledgerloom.session import local_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8,
        "tests",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__sql__shuffle__partitions="2",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data() -> str:
    return DATA


@pytest.fixture()
def duck(data):
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for table in ("customer", "lineitem", "nation", "orders"):
        connection.execute(f"create view {table} as select * from '{data}/{table}.parquet'")
    yield connection
    connection.close()
