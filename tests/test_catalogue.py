"""Each query of the catalogue against its oracle on another engine."""

import pytest
from parity import connect, difference

from catalogloom import plans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_same_rows(spark, con, name):
    assert difference(plans.QUERIES[name](spark, SF), con, plans.ORACLES[name]) == ""


def test_whole_tables(spark):
    orders, customers = (spark.read.parquet(f"{SF}/{x}.parquet") for x in ("orders", "customer"))
    n = orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "left_semi").count()
    for name, column in (("nested_export", "n"), ("rollup_present_counts", "total")):
        assert sum(r[column] for r in plans.QUERIES[name](spark, SF).collect()) == n > 0
    assert plans.QUERIES["deal_packages"](spark, SF).count() == customers.count()


def test_view_sums_gather_no_rows(spark):
    assert "collect_list" not in plans.QUERIES["view_sums"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLES)))
def test_runs(spark, name):
    assert plans.QUERIES[name](spark, SF).count() > 0


@pytest.mark.parametrize("name", ["crawl_labels", "force_from_categories", "entity_fields", "shared_inputs"])
def test_rows_of_a_file_are_dealt(spark, name):
    plan = plans.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "Expand" not in plan
