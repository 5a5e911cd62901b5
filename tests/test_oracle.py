"""Every registered query against its SQL oracle on the smallest data."""

import warnings

import pytest
from oracle_check import TESTDATA, compare, connect

import __spark_entry__ as entry
from leaguescore.oracle import ORACLES
from leaguescore.registry import QUERIES

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() <= entry.queries().keys()
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_oracle(spark, con, name):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert compare(spark, con, SF_DIR, name) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
