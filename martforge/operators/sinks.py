"""Keyed write semantics as DataFrame transforms.

Without a MERGE-capable table format, a load is expressed as
``(existing, incoming) -> next`` and the result is written as a new table
version (see ``martforge.sources.store``).  Never overwrite a path being read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO NOTHING``: existing rows win, new keys are appended."""
    keys = list(keys)
    fresh = incoming.select(*existing.columns).join(existing.select(*keys), on=keys, how="left_anti")
    return existing.unionByName(fresh)


def upsert(existing: DataFrame, incoming: DataFrame, key: Sequence[str], update_columns: Sequence[str],
           surrogate: str | None = None, new_surrogate=None) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO UPDATE SET update_columns = EXCLUDED.*`` (SCD Type 1).

    * keys present in ``incoming`` take its values for ``update_columns``;
    * keys only in ``existing`` are kept unchanged (no delete);
    * the surrogate key of an existing row is preserved; new rows get
      ``new_surrogate`` (a Column over the incoming row).

    One full-outer join on the key: a single shuffle of both sides.
    """
    key = list(key)
    cols = existing.columns
    e = existing.select(*[F.col(c).alias(f"e__{c}") for c in cols], F.lit(True).alias("e__present"))
    i = incoming.select(*[F.col(c).alias(f"i__{c}") for c in incoming.columns if c in cols or c in key],
                        *([new_surrogate.alias("i__new_surrogate")] if surrogate else []),
                        F.lit(True).alias("i__present"))
    cond = [e[f"e__{k}"] == i[f"i__{k}"] for k in key]
    j = e.join(i, on=cond, how="full_outer")
    in_source = F.col("i__present").isNotNull()
    out = []
    for c in cols:
        if c in key:
            out.append(F.coalesce(F.col(f"e__{c}"), F.col(f"i__{c}")).alias(c))
        elif c == surrogate:
            out.append(F.coalesce(F.col(f"e__{c}"), F.col("i__new_surrogate")).alias(c))
        elif c in update_columns:
            out.append(F.when(in_source, F.col(f"i__{c}")).otherwise(F.col(f"e__{c}")).alias(c))
        else:
            out.append(F.when(F.col("e__present").isNotNull(), F.col(f"e__{c}")).otherwise(F.col(f"i__{c}")).alias(c))
    return j.select(*out)


def load_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table: ``SELECT 't', count(*) ... UNION ALL ...``."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
