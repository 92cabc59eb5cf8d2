"""Plan assertions over every registered query (built on the sf0.001 driver tables)."""

import os

import pytest

SF = "/root/testdata/sf0.001"
# Queries whose plans must never funnel rows through one task.
NO_SINGLE_PARTITION = {"fact_orders", "fact_sessions", "dedup_latest", "dim_customer_scd2", "rfm_scores",
                       "ntile_distributed", "stg_order_items", "asof_customer_join", "cohort_retention", "customer_ltv"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.slow
@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_no_cartesian_or_nested_loop_and_no_single_task_stages(spark):
    import __spark_entry__ as E
    from martforge.plans.registry import REGISTRY
    bad = []
    for name, fn in E.queries().items():
        if name not in REGISTRY:
            continue
        plan = _plan(fn(spark, SF))
        if "CartesianProduct" in plan or "NestedLoopJoin" in plan:
            bad.append(f"{name}: cartesian/nested loop")
        if name in NO_SINGLE_PARTITION and "SinglePartition" in plan:
            bad.append(f"{name}: SinglePartition exchange")
    assert not bad, bad
