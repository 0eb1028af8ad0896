from pathlib import Path

import pytest
from oracle_check import compare, connect

from cartyield import EXACT
from cartyield.plans import queries as catalogue
from cartyield.plans.oracle import oracle_sql
from cartyield.plans.workspace import Workspace

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no tables")


def test_every_query_has_sql():
    """But for the estimate by random walks, which test_projection compares with what a search meets."""
    assert set(catalogue.queries()) == set(oracle_sql()) | {"search_size"}


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.fixture(scope="module", autouse=True)
def brands_mined_once(spark):
    """Queries that only shape the itemsets of the brands share one run."""
    whole, kept = catalogue.mined_brands, {}

    def mined_brands(session, folder, mode=EXACT):
        if mode not in kept:
            kept[mode] = Workspace(session).store(whole(session, folder, mode), "itemsets")
        return kept[mode]

    catalogue.mined_brands = mined_brands
    yield
    catalogue.mined_brands = whole


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_agrees_with_sql(spark, db, name):
    assert compare(spark, db, FOLDER, name) is None
