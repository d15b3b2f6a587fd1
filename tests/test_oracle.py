"""Every named query against independent SQL, on the smallest tables."""

from __future__ import annotations

from functools import lru_cache

import pytest

import __spark_entry__ as entry
from fairlead.plans import catalogue, oracle
from tests.conftest import SMALL
from tests.oracle_check import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.fixture(scope="module", autouse=True)
def shared_stages():
    """Lets the queries of this module read one set of stage tables."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(catalogue, "analysis", lru_cache(catalogue.analysis))
        yield


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(oracle.oracle_sql())
    assert set(catalogue.queries()) <= set(entry.queries())
    assert set(oracle.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_sql(spark, con, name):
    rows, problem = compare(spark, con, SMALL, catalogue.queries()[name], oracle.oracle_sql()[name])
    assert problem is None
    assert rows > 0 or name == "pending_days"  # every slot of the small table has a candidate


def test_query_as_registered_equals_sql(spark, con):
    """Without the shared stage tables."""
    name = "event_summary"
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(catalogue, "analysis", catalogue.analysis.__wrapped__)
        _, problem = compare(spark, con, SMALL, entry.queries()[name], entry.oracle_sql()[name])
    assert problem is None


def test_entry_has_rows(spark):
    ranked = entry.entry(spark)
    assert {"pair_id", "mean_pair_proportion", "vessel_in_pair"} <= set(ranked.columns)
    ratios = [r.mean_pair_proportion for r in ranked.collect()]
    assert ratios and ratios == sorted(ratios, reverse=True)
