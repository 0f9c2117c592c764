from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from reelmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as sorted tuples."""
    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect


@pytest.fixture(scope="module")
def many_slices(spark):
    """Keep small shuffles in several partitions, as big ones are, so that ranges really are ranges."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    yield
    spark.conf.set(setting, before)
