"""Every registered query against its SQL counterpart in another engine."""

import pytest
from compare import connect, difference

from turnstile import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert registry.queries().keys() == registry.oracle_sql().keys()


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, FOLDER)
    assert difference(df, con, registry.oracle_sql()[name]) is None
