"""The shape of the physical plans, where it decides how a query scales."""

import re

import pytest

from siltstone.operators.history import scd2
from siltstone.plans import catalog
from siltstone.plans.marts import build
from workload import views
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_row_wise_python_and_no_pairing_of_everything(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search(r"EvalPython|InPandas|CartesianProduct|BroadcastNestedLoop", text)


@pytest.mark.parametrize("tracked", [None, ["event_type"]])
def test_history_has_one_shuffle_and_one_sort(spark, tracked):
    events = views.order_events(spark, SF)
    text = plan(scd2(events, ["user_id"], "ts", ["event_id"], deletes="event_type = 'error'", tracked=tracked))
    assert len(re.findall(r"Exchange ", text)) == 1 and len(re.findall(r"Sort ", text)) == 1


@pytest.mark.parametrize("spec,exchanges", [(catalog.AGG_PRODUCT_PERFORMANCE, 2), (catalog.DIM_CUSTOMER_ENRICHED, 2)])
def test_facts_are_summed_before_the_shuffle(spark, spec, exchanges):
    text = plan(build(spec, views.warehouse(spark, SF)))
    assert re.search(r"Exchange hashpartitioning.*\n[^\n]*HashAggregate\(keys=\[\w+_id#\d+L\], functions=\[partial_", text)
    assert len(re.findall(r"Exchange hashpartitioning", text)) <= exchanges


def test_marts_read_only_the_columns_they_use(spark):
    text = plan(build(catalog.AGG_PRODUCT_PERFORMANCE, views.warehouse(spark, SF)))
    assert "ReadSchema: struct<l_partkey:bigint,l_linenumber:int,l_extendedprice:double>" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string>" in text
