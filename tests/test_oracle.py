from __future__ import annotations

import pytest

from lendstrata.workload.oracles import oracle_sql
from lendstrata.workload.queries import queries
from tests.oracle import differences

SF_DIR = "/root/testdata/sf0.01"


def test_every_query_has_an_oracle():
    assert queries().keys() == oracle_sql().keys()


@pytest.mark.parametrize("name", list(queries()))
def test_matches_oracle(spark, name):
    assert differences(spark, name, SF_DIR) == []
