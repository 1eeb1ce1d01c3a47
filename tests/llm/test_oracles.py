"""Queries against their SQL."""

from __future__ import annotations

import pytest

from lendstrata.llm.oracles import oracle_sql
from lendstrata.llm.queries import queries
from tests.oracle import differences

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_matches_oracle(spark, name):
    assert differences(spark, name, SF_DIR, queries()[name], oracle_sql()[name]) == []
