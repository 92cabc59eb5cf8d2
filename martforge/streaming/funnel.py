"""Rolling session funnel from an event stream.

Events (``user_id, ts, event_type, props``) are sessionised per user and
calendar day in event time: ``withWatermark`` bounds the state (a day's
sessions are final once the watermark passes the day's end, and events later
than the watermark delay are dropped), and a windowed aggregation keeps one
state row per (user, day).  In update mode every micro-batch emits the
sessions it changed; ``foreachBatch`` upserts them (SCD1 rule: the newest
aggregate of a key replaces the old one) into a versioned session table, so
the table is always the batch answer over everything seen so far.  The daily
funnel is a plain aggregate over that table.

Session rules match the warehouse's session feed: pages = events, cart = any
click, checkout = cart and any signup, purchase = checkout and any purchase,
source = the first event's ``k`` (fixed source list below).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions import columns as C
from martforge.operators.sinks import upsert
from martforge.sources.fixtures import UTM_SOURCES
from martforge.sources.store import TableStore

SESSION_KEY = ["user_id", "day"]


def sessions_from_events(events: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Per (user, day) session aggregates; works on a stream or a static frame."""
    k = F.get_json_object("props", "$.k").cast("int")
    # Watermarks need an instant (TIMESTAMP); the NTZ wall clock is read as UTC
    # through epoch microseconds, so the session time zone cannot shift days.
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    instant = F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, F.col("ts")))
    timed = events.withColumn("event_time", instant)
    g = timed.withWatermark("event_time", watermark).groupBy("user_id", F.window("event_time", "1 day").alias("w")).agg(
        F.min("ts").alias("started_ts"), F.max("ts").alias("ended_ts"), F.count(F.lit(1)).alias("pages_viewed"),
        F.bool_or(F.col("event_type") == "click").alias("clicked"),
        F.bool_or(F.col("event_type") == "signup").alias("signed_up"),
        F.bool_or(F.col("event_type") == "purchase").alias("bought"),
        F.min_by(k, F.struct("ts", "event_id")).alias("k"),
    )
    return g.select(
        "user_id", F.to_date("started_ts").alias("day"), "started_ts", "ended_ts", "pages_viewed",
        F.col("clicked").alias("added_to_cart"),
        (F.col("clicked") & F.col("signed_up")).alias("reached_checkout"),
        (F.col("clicked") & F.col("signed_up") & F.col("bought")).alias("purchased"),
        F.nullif(F.element_at(F.array(*map(F.lit, UTM_SOURCES)), (F.col("k") % len(UTM_SOURCES)) + 1), F.lit("")).alias("utm_source"),
    )


def daily_funnel(sessions: DataFrame) -> DataFrame:
    counts = sessions.groupBy("day").agg(
        F.count(F.lit(1)).alias("visited"), F.count_if("added_to_cart").alias("carted"),
        F.count_if("reached_checkout").alias("checked_out"), F.count_if("purchased").alias("purchased"))
    return counts.select(
        "day", "visited", "carted", "checked_out", "purchased",
        C.pct("carted", "visited").alias("pct_browse_to_cart"),
        C.pct("purchased", "visited").alias("pct_visit_to_purchase"),
    )


def run_session_stream(spark: SparkSession, events_path: str, table: str, checkpoint: str,
                       store: TableStore | None = None, watermark: str = "1 day") -> DataFrame:
    """One availableNow run over newly arrived event files; returns the session table."""
    store = store or TableStore(spark)
    schema = spark.read.parquet(events_path).schema
    stream = spark.readStream.schema(schema).parquet(events_path)
    update_cols = ["started_ts", "ended_ts", "pages_viewed", "added_to_cart", "reached_checkout", "purchased", "utm_source"]

    def merge(batch: DataFrame, epoch_id: int) -> None:
        current = store.read(table) if store.current_version(table) else None
        merged = batch if current is None else upsert(current, batch.select(*current.columns), SESSION_KEY, update_cols)
        store.publish(table, store.write_version(table, merged))

    q = (sessions_from_events(stream, watermark).writeStream.outputMode("update").foreachBatch(merge)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return store.read(table)
