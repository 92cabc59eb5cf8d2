"""Surrogate keys.

A dimension's surrogate key is a 64-bit hash of its natural key (plus
``effective_from`` for SCD2 versions).  It is computed row-locally — no global
counter, no single task, stable across re-runs and task retries — and guarded
by a uniqueness check (``martforge.operators.checks.unique``).  Collision odds
are about n^2 / 2^65: negligible below 10^8 rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def surrogate_key(*natural_key: str | Column) -> Column:
    """Deterministic BIGINT key from the natural key columns."""
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in natural_key])


def dense_surrogate_keys(df: DataFrame, natural_key: Sequence[str], out: str = "surrogate_key", offset: int = 0) -> DataFrame:
    """Fallback when the hash key collides: dense BIGINT keys ``offset+1 ...`` in natural-key order.

    Computed with the distributed global row number (range buckets, no
    single-task window); deterministic for a given set of natural keys.
    """
    from martforge.operators.ranking import global_row_number
    numbered, _ = global_row_number(df, list(natural_key), out=out)
    return numbered.withColumn(out, (F.col(out) + F.lit(offset)).cast("long"))


def assign_keys(key_map: DataFrame, rows: DataFrame, natural_key: Sequence[str], out: str = "surrogate_key") -> DataFrame:
    """The map natural key -> dense BIGINT key, with the natural keys of ``rows`` that it did not hold.

    Keys once given never change, whatever a load brings; new ones go on from the greatest
    key, in natural-key order, numbered over range partitions.  No hash decides, so no two
    natural keys can meet.  Parts of a natural key may be NULL (they agree with each other);
    repeated rows get one key; with nothing new the map stays as it is.  ``key_map`` is read
    twice: hand in a written table, and write what comes back as its next version.
    """
    names = list(natural_key)
    held = key_map.select(*[F.col(c).alias(f"__held_{c}") for c in names])
    same = F.lit(True)
    for c in names:
        same = same & F.col(c).eqNullSafe(F.col(f"__held_{c}"))
    new = rows.select(*names).distinct().join(held, same, "left_anti")
    last = key_map.agg(F.max(out).alias("k")).first()["k"] or 0   # one value
    return key_map.unionByName(dense_surrogate_keys(new, names, out, offset=last).select(*key_map.columns))


def with_keys(rows: DataFrame, key_map: DataFrame, natural_key: Sequence[str], out: str = "surrogate_key") -> DataFrame:
    """``rows`` with the key of each natural key; NULL where the map does not hold it."""
    names = list(natural_key)
    held = key_map.select(*[F.col(c).alias(f"__held_{c}") for c in names], out)
    same = F.lit(True)
    for c in names:
        same = same & F.col(c).eqNullSafe(F.col(f"__held_{c}"))
    return rows.join(held, same, "left").select(*rows.columns, out)
