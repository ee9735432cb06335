"""Every registered query beside its SQL counterpart on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from lakecare.catalog.oracle import ORACLE
from lakecare.catalog.queries import QUERIES
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
TRAINING = {"readmission_predictions", "readmission_model_report"}  # covered by the layer tests

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_counterpart_belongs_to_a_query():
    assert set(QUERIES) - set(ORACLE) == TRAINING
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) is None
