"""Every registered query against its SQL twin on the smallest tables."""

import pytest

from tests.conftest import SF_DIR
from tests.parity import compare
from tidemark.plans import load_all

REGISTRY = load_all()


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_sql(spark, duck, name):
    ok, note = compare(spark, duck, REGISTRY[name], SF_DIR)
    assert ok, note


def test_entry_contract():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.queries()) > 200
