"""Every registered query with an oracle equals it on the smallest tables; the others give rows."""

import os

import pytest

from tests.conftest import SMALL_DIR
from textloom.queries import ORACLES, QUERIES
from tools.check import compare, oracle_connection

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL_DIR), reason="test tables are absent")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SMALL_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, con, name):
    assert compare(spark, con, name, SMALL_DIR) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, con, name):
    assert compare(spark, con, name, SMALL_DIR) is None


def test_names_of_oracles_are_queries():
    assert set(ORACLES) <= set(QUERIES)
