from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session", autouse=True)
def shared(spark, tmp_path_factory):
    """The shared folder of the tests."""
    folder = f"file://{tmp_path_factory.mktemp('shared')}"
    spark.sparkContext.setCheckpointDir(folder)
    return folder
