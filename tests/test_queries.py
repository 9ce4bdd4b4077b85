"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect
from voxmill.plans.catalog import CHECKS, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    message, _ = compare(spark, duck, SF_DIR, QUERIES[name], CHECKS[name])
    assert message is None, message


def test_flagship(spark):
    assert entry.entry(spark).columns == ["grp", "rank", "ngram", "tfidf", "n", "type"]
