"""Raw landing: CSV feeds read as all-text tables stamped with one load time.

Reader contract (same as a database ``COPY ... CSV HEADER``):
* explicit all-text schema, header line skipped, columns taken by position;
* ``"`` quotes and escapes itself (``""q""`` -> ``"q"``); quoted newlines are
  part of the value;
* an unquoted empty field is NULL, a quoted ``""`` is the empty string;
* a record with too many or too few fields fails the load (FAILFAST).

``multiLine`` makes a single file unsplittable; at scale land many files per
feed (parallelism = number of files), or pass ``multiline=False`` for feeds
known to contain no embedded newlines so large files split across tasks.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge import schemas as S
from martforge.operators.sinks import load_summary


def load_timestamp(run_ts) -> Column:
    """One constant load time per run (never ``current_timestamp()`` evaluated twice)."""
    if isinstance(run_ts, _dt.datetime):
        run_ts = run_ts.isoformat(sep=" ")
    return F.lit(str(run_ts)).cast("timestamp_ntz").alias("loaded_at")


def _reader(spark: SparkSession, schema, multiline: bool):
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)          # header names are not matched: position decides
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("nullValue", "\\N")             # so that ,"", stays an empty string...
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def read_feed(spark: SparkSession, path: str, feed: str, run_ts, *, multiline: bool = True) -> DataFrame:
    schema = S.RAW_CSV_SCHEMAS[feed]
    df = _reader(spark, schema, multiline).option("mode", "FAILFAST").csv(path)
    # ...while an unquoted empty field becomes NULL: Spark reads it as "" only
    # when quoted; unquoted empties arrive as NULL with nullValue unset.
    return df.select(*schema.fieldNames(), load_timestamp(run_ts))


def read_feed_lenient(spark: SparkSession, path: str, feed: str, run_ts, *, multiline: bool = True) -> DataFrame:
    """As ``read_feed``, but a record with too many or too few fields is kept: its text is in
    ``unparsed_record`` (NULL for a good one), for ``plans.quarantine`` to set aside."""
    schema = S.RAW_CSV_SCHEMAS[feed]
    kept = T.StructType([*schema.fields, T.StructField("unparsed_record", T.StringType(), True)])
    df = _reader(spark, kept, multiline).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "unparsed_record").csv(path)
    return df.select(*schema.fieldNames(), "unparsed_record", load_timestamp(run_ts))


def write_feed_csv(df: DataFrame, path: str, feed: str, mode: str = "append") -> None:
    """Write a feed as CSV the landing reader reads back unchanged (NULL as an
    unquoted empty field, '' as ``""``, blanks kept, quotes doubled)."""
    (df.select(*S.RAW_COLUMNS[feed]).write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
       .option("emptyValue", '""').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


def land(spark: SparkSession, csv_dir: str, run_ts, *, multiline: bool = True, lenient: bool = False) -> dict[str, DataFrame]:
    """Read the five feeds ``<csv_dir>/<feed>.csv``; with ``lenient`` records that do not parse are kept apart."""
    base, read = csv_dir.rstrip("/"), read_feed_lenient if lenient else read_feed
    return {feed: read(spark, f"{base}/{feed}.csv", feed, run_ts, multiline=multiline) for feed in S.FEEDS}


def raw_load_summary(raw: dict[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` per raw table (a five-way UNION ALL of counts)."""
    return load_summary(raw)
