import os

import pytest

from verification import compare, oracle, registry

SF_DIR = os.environ.get("OCCFLOW_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_a_twin():
    assert set(registry.QUERIES) == set(oracle.QUERIES)


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_same_rows(spark, connection, name):
    problem, _ = compare.difference(spark, connection, SF_DIR, name)
    assert problem is None
