from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from waymill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle_partitions=8, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set Spark settings for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)
