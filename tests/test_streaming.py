"""Structured Streaming paths: session stream equals the static computation."""

import datetime as dt
import tempfile

from martforge.sources.store import TableStore
from martforge.streaming.funnel import daily_funnel, run_session_stream, sessions_from_events
from tests.conftest import rows

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
D = dt.datetime(2024, 1, 1)


def test_session_stream_two_drops_equals_static(spark):
    base = tempfile.mkdtemp(prefix="martforge-stream-")
    drop1 = [(1, D + dt.timedelta(hours=1), 7, "view", 1.0, '{"k": 1}'), (2, D + dt.timedelta(hours=2), 7, "click", 1.0, '{"k": 2}'),
             (3, D + dt.timedelta(hours=3), 8, "view", 1.0, '{"k": 7}')]
    # second drop updates user 7's first day (signup + purchase) and opens a new day
    drop2 = [(4, D + dt.timedelta(hours=5), 7, "signup", 1.0, '{"k": 3}'), (5, D + dt.timedelta(hours=6), 7, "purchase", 1.0, '{"k": 4}'),
             (6, D + dt.timedelta(days=1, hours=1), 8, "click", 1.0, '{"k": 5}')]
    store = TableStore(spark, f"{base}/store")
    spark.createDataFrame(drop1, SCHEMA).coalesce(1).write.parquet(f"{base}/events/a")
    path = f"{base}/events/*"
    run_session_stream(spark, path, "sessions", f"{base}/ckpt", store)
    spark.createDataFrame(drop2, SCHEMA).coalesce(1).write.parquet(f"{base}/events/b")
    streamed = run_session_stream(spark, path, "sessions", f"{base}/ckpt", store)
    static = sessions_from_events(spark.createDataFrame(drop1 + drop2, SCHEMA))
    assert rows(streamed) == rows(static.select(*streamed.columns))
    funnel = {r["day"]: r for r in daily_funnel(streamed).collect()}
    assert funnel[D.date()]["visited"] == 2 and funnel[D.date()]["purchased"] == 1


def test_equal_load_times_keep_the_later_arrival(spark):
    from martforge import schemas as S
    from martforge.streaming.incremental import merge_latest
    columns = list(S.RAW_COLUMNS["orders"])
    def order(status):
        return spark.createDataFrame([tuple("1" if c == "order_id" else status if c == "status" else "x" for c in columns)],
                                     ", ".join(f"{c} string" for c in columns)).selectExpr("*", "TIMESTAMP_NTZ '2021-01-01 00:00:00' AS loaded_at")

    merged = merge_latest(merge_latest(None, order("refunded"), "orders"), order("cancelled"), "orders")
    assert [r["status"] for r in merged.collect()] == ["cancelled"]


def test_interrupted_publish_keeps_the_old_rows(spark):
    """A log append that dies in the middle leaves the last published version live."""
    import uuid
    import pytest
    from pyspark.sql import functions as F
    from martforge.sources.store import TableStore
    store, name = TableStore(spark), f"interrupted-{uuid.uuid4().hex}"
    assert store.current_version(name) is None
    store.publish(name, store.write_version(name, spark.range(3)))
    broken = spark.range(1).select(F.lit(2).cast("long").alias("number"), F.raise_error(F.lit("lost")).cast("string").alias("version"))
    with pytest.raises(Exception, match="lost"):
        broken.write.mode("append").json(store._pointer(name))
    assert store.read(name).count() == 3
    store.publish(name, store.write_version(name, spark.range(5)))
    assert store.read(name).count() == 5
