"""Corpus-wide counts over a bounded range of numbers, gathered while another pass writes its rows.

A pass adds one row per task to what it writes: the task's counts, as little-endian
64-bit integers in the column ``tally`` (null in all other rows).  ``total`` sums these
rows: per task first, then per number.  The driver gets at most ``size`` rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def total(table: DataFrame, size: int) -> np.ndarray:
    """Sum of all ``tally`` rows: ``size`` counts."""
    schema = pa.schema([("at", pa.int32()), ("n", pa.int64())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, dtype=np.int64)
        for b in batches:
            for raw in b.column(0):
                counts += np.frombuffer(raw.as_buffer(), dtype="<i8")
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], schema=schema)

    per_task = table.where(F.col("tally").isNotNull()).select("tally").mapInArrow(add, "at int, n long")
    counts = np.zeros(size, dtype=np.int64)
    for r in per_task.groupBy("at").agg(F.sum("n").alias("n")).collect():
        counts[r["at"]] = r["n"]
    return counts
