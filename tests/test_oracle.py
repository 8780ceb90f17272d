"""Every registered query against its SQL, over the smallest whole tables."""

import pytest
from oracle import TESTDATA, compare, contract, database

from strataflow.plans import registry

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(SF_DIR)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_agrees_with_sql(spark, db, name):
    outcome = compare(spark, db, SF_DIR, name)
    assert outcome[0] in ("match", "rows only"), outcome
    assert outcome[1] > 0


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
