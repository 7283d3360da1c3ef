"""Queries that SQL can express, on the smallest data folder."""

import pytest

pytest.importorskip("siltworks.llm")

from siltworks.llm.queries import REGISTRY  # noqa: E402
from siltworks.llm.sql import ORACLE  # noqa: E402
from tests.compare import SAME_TYPE, differences, sql_connection  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_query(spark, name, monkeypatch):
    monkeypatch.setitem(SAME_TYPE, "boolean", "BOOLEAN")
    assert differences(REGISTRY[name](spark, SF_DIR), sql_connection(SF_DIR), ORACLE[name]) is None
