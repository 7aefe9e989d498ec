"""Every registered query against its DuckDB text; an empty result is a failure."""

import pytest
from check_oracle import compare, connect
from __spark_entry__ import FLAGSHIP, entry, oracle_sql, queries
from tidemark.plans import REGISTRY

QUERIES, ORACLES = {n: q for n, q in queries().items() if n in REGISTRY}, {n: q for n, q in oracle_sql().items() if n in REGISTRY}


#: The smallest data in which every report finds something.
DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    problem = compare(df, duck, ORACLES[name])
    assert problem is None, problem


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert FLAGSHIP in QUERIES


def test_entry(spark):
    assert entry(spark).count() > 0


def test_names_follow_the_inventory():
    numbers = {int(n[1:4]) for n in QUERIES if n[0] == "q" and n[1:4].isdigit()}
    assert numbers == set(range(1, 106))
