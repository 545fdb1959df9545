from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tradewind.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows as tuples with a DDL schema, through literal SQL values rather than Python workers."""

    def build(schema: str, *rows: tuple):
        return spark.createDataFrame(list(rows), schema).coalesce(1)

    return build
