"""The training-data queries that SQL can restate, against their SQL."""

import os

import pytest

from marketvane.llm.queries import ORACLES, QUERIES
from tests.parity import connect, differences, type_differences

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are absent")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    want = connect(FOLDER).sql(ORACLES[name])
    assert type_differences(frame.schema, zip(want.columns, want.types)) == ""
    assert differences(frame.toPandas(), want.df()) == ""
