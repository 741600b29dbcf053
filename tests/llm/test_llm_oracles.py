"""Every corpus query against its SQL on the smallest tables."""

import check
import pytest

from kerbline.llm.oracles import ORACLES
from kerbline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert check.compare(spark, check.duck(SF), name, QUERIES[name], ORACLES[name], SF) is None
