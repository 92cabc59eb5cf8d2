"""Facts kept by month: a month is rewritten on its own, and a date range reads its months only.

Every write goes to a fresh version folder, partitioned by month.  The live table is one
release entry that names the version of every month, so publishing some new months is
atomic, all other months keep their files, and a month without rows simply leaves the
entry.  Readers get ``month`` as a partition column: a filter on it prunes folders.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.sources.store import TableStore

MONTH = "month"


def month_of(date_key: str | Column) -> Column:
    """YYYYMM of a YYYYMMDD key."""
    return F.floor((F.col(date_key) if isinstance(date_key, str) else date_key) / 100).cast("int")


class MonthlyTable:
    def __init__(self, store: TableStore, name: str, date_key: str):
        self.store, self.name, self.date_key = store, name, date_key
        self.release = f"{name}.months"

    def months(self) -> dict[int, str]:
        """Live version of every month (one entry per month of the calendar)."""
        last = self.store.last_release(self.release)
        return {int(m): v for m, v in last["tables"].items()} if last else {}

    def write(self, fact: DataFrame, months: Iterable[int] | None = None) -> dict[int, str]:
        """Replace ``months`` (default: all) by the rows of ``fact`` that lie in them; returns the months that now have rows.

        Rows of a month are brought together first, so that a month is a few files and not one per task;
        a frequent month spreads over several of them by its order within it.
        """
        rows = fact.withColumn(MONTH, month_of(self.date_key))
        keep: dict[int, str] = {}
        if months is not None:
            months = sorted({int(m) for m in months})
            rows = rows.where(F.col(MONTH).isin(months))
            keep = {m: v for m, v in self.months().items() if m not in set(months)}
        version = self.store.write_version(self.name, rows.repartitionByRange(MONTH, self.date_key, F.rand(seed=1)).sortWithinPartitions(MONTH, self.date_key), [MONTH])
        new = self.store.read(self.name, version, schema=rows.schema).select(MONTH).distinct().collect()   # as many as there are months
        self.store.publish_release(self.release, {str(m): v for m, v in {**keep, **{r[MONTH]: version for r in new}}.items()})
        return {r[MONTH]: version for r in new}

    def read(self, schema) -> DataFrame:
        """All live months; ``schema`` is the fact's (an empty table has no file to tell it)."""
        live = self.months()
        fields = T.StructType([*[f for f in schema.fields if f.name != MONTH], T.StructField(MONTH, T.IntegerType())])
        if not live:
            return self.store.spark.createDataFrame([], fields)
        base = f"{self.store.root}/{self.name}"
        paths = [f"{base}/v={v}/{MONTH}={m}" for m, v in sorted(live.items())]
        return self.store.spark.read.schema(fields).option("basePath", base).parquet(*paths).select(*fields.names)

    def between(self, schema, first_key: int, last_key: int) -> DataFrame:
        """Rows of the dates from ``first_key`` to ``last_key`` (YYYYMMDD): only their months are opened."""
        df = self.read(schema)
        return df.where(F.col(MONTH).between(first_key // 100, last_key // 100) & F.col(self.date_key).between(first_key, last_key))
