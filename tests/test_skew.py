"""A customer holding a large share of all orders: the point-in-time join stays
correct when AQE splits the hot partition, and the explicit salt agrees."""

import datetime as dt

from pyspark.sql import functions as F

from martforge.operators.joins import asof_window_join
from tests.conftest import rows


def test_hot_customer_pit_join_is_skew_split_and_correct(spark):
    t0 = dt.datetime(2020, 1, 1)
    versions = spark.createDataFrame(
        [(c, c * 10 + v, t0 + dt.timedelta(days=100 * v), t0 + dt.timedelta(days=100 * (v + 1)) if v < 2 else dt.datetime(9999, 12, 31))
         for c in range(50) for v in range(3)],
        "vid long, version long, effective_from timestamp_ntz, effective_to timestamp_ntz")
    # customer 0 holds 40k of 45k orders
    orders = spark.range(0, 45000).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") < 40000, F.lit(0)).otherwise(F.col("id") % 50).cast("long").alias("cid"),
        (F.lit(t0).cast("timestamp_ntz") + F.make_dt_interval(F.col("id") % 300)).alias("ts"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        joined = asof_window_join(orders, versions, "cid", "vid", "ts").select("order_id", "version")
        got = sorted(tuple(r) for r in joined.collect())
        final_plan = joined._jdf.queryExecution().executedPlan().toString()   # AQE's final plan after execution
        assert "SortMergeJoin" in final_plan and "skew=true" in final_plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    expected = rows(asof_window_join(orders, F.broadcast(versions), "cid", "vid", "ts"), "order_id", "version")
    salted = rows(asof_window_join(orders, versions, "cid", "vid", "ts", salt_buckets=8, salt_of="order_id"), "order_id", "version")
    assert got == sorted(expected) == sorted(salted) and len(got) == 45000
