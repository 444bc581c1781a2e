from __future__ import annotations

import pytest

from civicloom.queries.registry import ready
from civicloom.session import build_session, fresh_path


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    ready(session)
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return fresh_path(spark, "test")
