"""Join operators the warehouse needs beyond plain equi-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def asof_window_join(facts: DataFrame, versions: DataFrame, fact_key: str, version_key: str, fact_ts: str,
                     valid_from: str = "effective_from", valid_to: str = "effective_to", how: str = "inner",
                     salt_buckets: int = 1, salt_of: str | None = None) -> DataFrame:
    """Point-in-time join: key equal AND ``valid_from <= ts < valid_to`` (half-open).

    Planned as an equi-join on the key with the range as a residual condition
    (sort-merge join with condition; never a nested loop or a cartesian).
    ``how='inner'`` drops facts before the first version; ``how='left'`` keeps
    them with NULL version columns.

    Skew: AQE's skew-join split handles a hot key for both inner and left joins
    (the fact side is the one that is split).  ``salt_buckets > 1`` adds an
    explicit, retry-safe salt for engines without AQE: the fact side is spread
    over ``salt_buckets`` by a hash of ``salt_of`` (a fact column), the version
    side is replicated that many times.
    """
    f, v = facts, versions
    cond: list[Column] = [f[fact_key] == v[version_key], f[fact_ts] >= v[valid_from], f[fact_ts] < v[valid_to]]
    if salt_buckets > 1:
        salt_src = salt_of or fact_ts
        f = f.withColumn("__salt", F.pmod(F.xxhash64(F.col(salt_src)), F.lit(salt_buckets)))
        v = v.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
        cond = [f[fact_key] == v[version_key], f["__salt"] == v["__salt"], f[fact_ts] >= v[valid_from], f[fact_ts] < v[valid_to]]
        return f.join(v, on=cond, how=how).drop(f["__salt"]).drop(v["__salt"])
    return f.join(v, on=cond, how=how)


def semi_join(child: DataFrame, parent: DataFrame, child_key: Sequence[str], parent_key: Sequence[str] | None = None) -> DataFrame:
    """``WHERE EXISTS (SELECT 1 FROM parent WHERE parent.k = child.k)``."""
    parent_key = list(parent_key or child_key)
    p = parent.select(*[F.col(pk).alias(ck) for pk, ck in zip(parent_key, child_key)])
    return child.join(p, on=list(child_key), how="left_semi")


def anti_join(child: DataFrame, parent: DataFrame, child_key: Sequence[str], parent_key: Sequence[str] | None = None) -> DataFrame:
    """``LEFT JOIN parent ... WHERE parent.k IS NULL`` / ``NOT EXISTS``."""
    parent_key = list(parent_key or child_key)
    p = parent.select(*[F.col(pk).alias(ck) for pk, ck in zip(parent_key, child_key)])
    return child.join(p, on=list(child_key), how="left_anti")


def optional_reference_filter(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Keep rows whose (nullable) reference is NULL, or whose parent exists.

    ``k IS NULL OR EXISTS (parent WHERE parent.k = k)`` written as the union
    of the anonymous rows and a semi-join of the known rows: the disjunction
    would otherwise become an existence join that evaluates the key for
    every row.  Callers normalise blanks to NULL first.
    """
    anonymous = child.where(F.col(key).isNull())
    known = semi_join(child.where(F.col(key).isNotNull()), parent, [key], [parent_key or key])
    return anonymous.unionByName(known)
