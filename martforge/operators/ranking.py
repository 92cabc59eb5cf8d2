"""Distributed global row number and NTILE.

``ntile(k) OVER (ORDER BY v)`` without ``PARTITION BY`` makes Spark move every
row into a single task (``Exchange SinglePartition``).  This module computes
the same numbers with all work spread over range partitions:

1. ``repartitionByRange`` on a total order (order columns plus unique
   tie-breakers, so massive ties in the ordered value split, too);
2. the partition number is kept as a column and the rows are written as a table
   (evaluated once, where a checkpoint would do so twice), so a retried task cannot
   see another partitioning;
3. rows are counted per partition; prefix sums of these counts (one row per
   partition, a table like any other) are each partition's offset;
4. ``row_number`` runs per partition and is shifted by its offset;
5. tile = f(row number, n, k), the standard NTILE fill (first ``n mod k``
   tiles get one extra row).

The driver sees nothing but the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.sources.store import TableStore


def _numbered(df: DataFrame, orderings: dict[str, Sequence[str]], partitions: int | None = None) -> DataFrame:
    """``df`` with a global row number per ordering; ``df`` itself is evaluated by the first numbering only."""
    store = TableStore(df.sparkSession)
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = df
    for name, order in orderings.items():
        columns = [F.col(c).asc() for c in order]
        ranged = store.materialize("ranges", out.repartitionByRange(parts, *columns).withColumn("__range", F.spark_partition_id()))
        before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)   # one row per partition
        offsets = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
        offsets = store.materialize("offsets", offsets.select(F.col("__range"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")))
        within = Window.partitionBy("__range").orderBy(*columns)
        out = ranged.join(offsets, "__range").withColumn(name, (F.row_number().over(within) + F.col("__offset")).cast("long"))
        out = out.drop("__range", "__offset")
    return out


def global_row_numbers(df: DataFrame, orderings: dict[str, Sequence[str]], *, partitions: int | None = None) -> tuple[DataFrame, int]:
    """``row_number() OVER (ORDER BY ...)`` for several orderings, over range partitions.

    ``orderings`` maps an output column to its order columns, which must make
    rows unique (append natural-key tie-breakers).  ``partitions`` defaults to the
    session's shuffle partitions.  Returns (frame, n).
    """
    out = _numbered(df, orderings, partitions)
    return out, out.count()


def global_row_number(df: DataFrame, order_by: Sequence[str], *, out: str = "row_number", **kw) -> tuple[DataFrame, int]:
    """``row_number() OVER (ORDER BY order_by)`` computed over range buckets (see ``global_row_numbers``)."""
    return global_row_numbers(df, {out: order_by}, **kw)


def ntile_of(row_number: Column, n: int, k: int) -> Column:
    """NTILE(k) of a 1-based row number among n rows."""
    q, r = divmod(n, k)
    rn = row_number.cast("long")
    if q == 0:
        return rn.cast("int")
    big = r * (q + 1)
    return F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1).otherwise(
        F.floor((rn - 1 - big) / q) + r + 1).cast("int")


def ntile_distributed(df: DataFrame, k: int, order_by: Sequence[str], *, out: str = "ntile", **kw) -> DataFrame:
    """``ntile(k) OVER (ORDER BY order_by)`` without a single-partition window."""
    return ntiles_distributed(df, k, {out: order_by}, **kw)


def ntiles_distributed(df: DataFrame, k: int, orderings: dict[str, Sequence[str]], **kw) -> DataFrame:
    """Several ``ntile(k)`` columns, one per ordering, sharing the setup jobs."""
    tmp = {f"__rn_{name}": order for name, order in orderings.items()}
    numbered, n = global_row_numbers(df, tmp, **kw)
    for name in orderings:
        numbered = numbered.withColumn(name, ntile_of(F.col(f"__rn_{name}"), n, k))
    return numbered.drop(*tmp)


def group_ranks(df: DataFrame, groups: Sequence[str], value: str, *, partitions: int | None = None) -> DataFrame:
    """Per-group ranking columns without a task that holds a whole group.

    Adds ``rank_asc`` (= ``rank() OVER (PARTITION BY groups ORDER BY value)``),
    ``dense_rank_desc`` (= ``dense_rank() ... ORDER BY value DESC``), ``group_rows``
    and ``group_total`` (sum of value).  ``value`` must be non-NULL.

    Rows collapse to distinct (group, value) pairs with their counts, partial per task,
    so a value that many rows share is one row.  One range partitioning by (group, value)
    cuts a group of any size; the windows run inside (range, group), and what lies in
    other ranges of a group is added from one row per (range, group).  Group keys may be
    NULL; they are joined null-safely.  ``df`` is read twice: hand in a written table.
    """
    groups = list(groups)
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = df.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("__rows"))
    # a retried task must not see another partitioning
    ranged = TableStore(df.sparkSession).materialize(
        "ranges", pairs.repartitionByRange(parts, *groups, value).withColumn("__range", F.spark_partition_id()))
    here = Window.partitionBy("__range", *groups).orderBy(value)
    local = ranged.select(
        "__range", *groups, value, F.coalesce(F.sum("__rows").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__less"),
        F.row_number().over(here).alias("__pair"))
    per_range = ranged.groupBy("__range", *groups).agg(F.sum("__rows").alias("__n"), F.count(F.lit(1)).alias("__p"), F.sum(F.col(value) * F.col("__rows")).alias("__t"))
    whole = Window.partitionBy(*groups)
    along = whole.orderBy("__range")
    per_range = per_range.select(
        "__range", *groups, F.coalesce(F.sum("__n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
        F.sum("__p").over(along.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("__pairs_on"),
        F.sum("__n").over(whole).alias("group_rows"), F.sum("__t").over(whole).alias("group_total"))

    def joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
        other = right.select(*[F.col(c).alias(f"__r_{c}") for c in keys], *[c for c in right.columns if c not in keys])
        same = F.lit(True)
        for c in keys:
            same = same & left[c].eqNullSafe(other[f"__r_{c}"])
        return left.join(other, same).drop(*[f"__r_{c}" for c in keys])

    ranked = joined(local, per_range, ["__range", *groups]).select(
        *groups, value, (F.col("__before") + F.col("__less") + 1).cast("long").alias("rank_asc"),
        (F.col("__pairs_on") - F.col("__pair") + 1).cast("long").alias("dense_rank_desc"), "group_rows", "group_total")
    return joined(df, ranked, [*groups, value])
