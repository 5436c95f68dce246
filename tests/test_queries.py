"""Every registered query against its SQL equivalent."""

import os

import pytest

import __spark_entry__ as entry_module
import oracle
from tidemark.plans import registry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def db():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, db, name):
    sql = registry.ORACLES[name]
    assert oracle.compare(spark, FOLDER, db, registry.QUERIES[name], sql) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
