"""Registered queries against their SQL twins; BAZAAR_CORE=1 runs a core of them."""

import os

import pytest

import __spark_entry__ as e
from bazaarlens.plans import registry
from bazaarlens.plans.star import STAGED
from compare import connect, difference
from oracle.statements import STATEMENTS

DATA = "/root/testdata/sf0.001"
CORE = [
    *STAGED, "src_csv", "int_orders", "int_order_reviews", "int_order_payments", "int_geolocation_by_zip", "review_flag",
    "dim_customers", "fct_orders", "fct_order_items", "mart_customer_summary", "mart_seller_performance", "win_dedup",
    "win_ntile", "win_cumsum", "win_qcut", "win_topshare", "an_kpi", "an_qoq", "an_quintile", "an_quintile_mix",
    "an_customer_pareto", "an_state_equity", "an_distance_cov", "an_corr_matrix", "an_weight_profile", "an_priority",
    "an_runway", "ex_return_gap", "dq_composite_key", "dq_rate_range",
]
TWINS = e.oracle_sql()
NAMES = CORE if os.environ.get("BAZAAR_CORE") else list(registry.QUERIES)


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.mark.parametrize("name", NAMES)
def test_twin(spark, duck, name):
    assert difference(e.queries()[name](spark, DATA), duck, TWINS[name]) is None


def test_every_query_has_a_twin():
    assert set(registry.QUERIES) == set(STATEMENTS)
    assert set(registry.QUERIES) <= set(e.queries()) and set(TWINS) <= set(e.queries())
