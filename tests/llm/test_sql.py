"""The training-text queries that SQL can express, against their SQL."""

from __future__ import annotations

import pytest

from checks.compare import differences, duck
from partura.llm.queries import llm_oracles, llm_queries
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_matches_sql(spark, name):
    assert differences(spark, duck(SMALL), SMALL, name) == ""


def test_sql_is_of_queries():
    assert llm_oracles().keys() <= llm_queries().keys()
