"""Operator queries next to their SQL."""

import os

import pytest
from check_oracles import compare, connect

from clipframe.llm.oracles import ORACLES

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF), SF, name) == ""
