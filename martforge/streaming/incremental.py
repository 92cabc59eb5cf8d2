"""Incremental landing: new feed files are merged into the deduplicated raw table.

The source warehouse reloads everything on every run and lists incremental
loads with a ``last_loaded_at`` high-water mark as future work.  In Spark the
high-water mark is the file source's checkpoint: a ``readStream`` over the
landing folder sees every file exactly once, ``trigger(availableNow=True)``
processes what has arrived and stops (a scheduled incremental run), and
``foreachBatch`` merges each micro-batch into the table.

The merge is the keep-newest rule (``operators.dedup``): the table holds, per
typed key, the greatest ``(loaded_at, raw columns...)`` row.  Because that is
a max, merging batch by batch gives exactly the full-reload result, whatever
the batch boundaries.  Each batch's load time is a single literal, so all rows
of one arrival share it, as with a database default of ``now()``.

Each merge rewrites the table as a new version in the shared store and moves
the pointer only after the write, so a failed or retried batch never leaves
a half-written table; a retried epoch recomputes from the last published
version.  Rewriting is O(table) per batch: with a MERGE-capable table format
the same rule becomes a keyed ``MERGE`` touching only the batch's keys.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge import schemas as S
from martforge.operators.dedup import dedup_latest
from martforge.sources.landing import load_timestamp
from martforge.sources.store import TableStore

KEY_TYPES = {
    "customers": {"customer_id": "bigint"},
    "products": {"product_id": "bigint"},
    "orders": {"order_id": "bigint"},
    "order_items": {"order_id": "bigint", "line_no": "int"},
    "sessions": {"session_id": "string"},
}


def _typed_keys(feed: str) -> list:
    return [F.col(c).cast(t).alias(f"__k_{c}") for c, t in KEY_TYPES[feed].items()]


def merge_latest(current: DataFrame | None, batch: DataFrame, feed: str) -> DataFrame:
    """Keep-newest merge of a raw batch into the current raw-latest table."""
    cols = list(S.RAW_COLUMNS[feed]) + ["loaded_at"]
    incoming = batch.select(*cols)
    rows = incoming.withColumn("__arrival", F.lit(1))
    if current is not None:  # of equal load times the later arrival is the newer row
        rows = current.select(*cols, F.lit(0).alias("__arrival")).unionByName(rows)
    keyed = rows.select(*_typed_keys(feed), *cols, "__arrival")
    keys = [f"__k_{c}" for c in KEY_TYPES[feed]]
    return dedup_latest(keyed, keys, ["loaded_at", "__arrival"], tiebreak=list(S.RAW_COLUMNS[feed])).select(*cols)


def start_incremental_load(spark: SparkSession, feed: str, landing_dir: str, table: str, checkpoint: str,
                           store: TableStore | None = None, clock=None):
    """Start (and return) a streaming query that merges newly landed CSV files of ``feed``.

    ``clock()`` gives each batch's load time (default: the time in UTC, to the microsecond).
    Call ``.awaitTermination()``; with availableNow the query stops once every
    file present at start has been merged.
    """
    store = store or TableStore(spark)
    clock = clock or (lambda: _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))
    stream = (
        spark.readStream.schema(S.RAW_CSV_SCHEMAS[feed])
        .option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
        .option("mode", "FAILFAST").option("nullValue", "\\N").option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(landing_dir)
    )

    def merge(batch: DataFrame, epoch_id: int) -> None:
        stamped = batch.select("*", load_timestamp(clock()))
        current = store.read(table) if store.current_version(table) else None
        version = store.write_version(table, merge_latest(current, stamped, feed))
        store.publish(table, version)

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def run_incremental_load(spark: SparkSession, feed: str, landing_dir: str, table: str, checkpoint: str,
                         store: TableStore | None = None, clock=None) -> DataFrame:
    """One scheduled incremental run: merge every new file, then return the published table."""
    store = store or TableStore(spark)
    q = start_incremental_load(spark, feed, landing_dir, table, checkpoint, store, clock)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return store.read(table)
