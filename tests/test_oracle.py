"""Every catalogue query against its SQL twin on the driver tables."""

import os

import pytest
from compare import compare, connect

from txlens.plans.catalog import QUERIES
from txlens.plans.oracle import ORACLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == ""


def test_only_the_models_lack_a_twin():
    assert set(QUERIES) - set(ORACLES) == {"train_gbt", "perm_importance"}
