"""Every registered query against its SQL, on the small data and on data with one hot person."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from checks.compare import differences, duck
from checks.oracle import all_oracles
from partura.plans.queries import all_queries
from tests.conftest import SMALL

HOT = ("event_timeline", "revised_timeline", "valid_outcomes", "episode_all_starts",
       "term_marker_counts", "pregnancy_episodes", "pregnancy_episodes_small_ids")


@pytest.fixture(scope="module")
def small():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_sql(spark, small, name):
    assert differences(spark, small, SMALL, name) == ""


def test_contract(spark):
    assert all_queries().keys() == all_oracles().keys()
    assert all_queries().keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()
    columns = contract.entry(spark).columns
    assert columns[0] == "person_id" and columns[-1] == "episode_length"


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """The small data with a third of all orders given to one customer."""
    folder = str(tmp_path_factory.mktemp("hot"))
    for table in ("lineitem", "customer", "part", "orders"):
        df = spark.read.parquet(f"{SMALL}/{table}.parquet")
        if table == "orders":
            df = df.selectExpr(
                "o_orderkey", "IF(o_orderkey % 3 = 0, 1, o_custkey) AS o_custkey"
            )
        df.coalesce(1).write.parquet(f"{folder}/{table}.parquet")
    con = duck(SMALL)
    for table in ("lineitem", "customer", "part", "orders"):
        con.execute(
            f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'"
        )
    return con, folder


@pytest.mark.parametrize("name", HOT)
def test_hot_person(spark, hot, name):
    con, folder = hot
    assert differences(spark, con, folder, name) == ""
