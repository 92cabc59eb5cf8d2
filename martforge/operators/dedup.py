"""Keep-newest deduplication.

Semantics: one row per key; the winner has the greatest ``order_by`` tuple
(``loaded_at`` first), ties broken by every remaining column, so the result
is a pure function of the input rows — independent of arrival order,
partitioning and task retries.  NULLs in the ordering tuple rank lowest
(``DESC NULLS LAST``).

Plan: a grouped ``max`` over a struct, not ``row_number()`` over a window.
The aggregate runs partial-then-final, so duplicates collapse map-side
before the shuffle and a hot key (say a third of all rows) reaches the
reducer as one row per map task instead of as one giant window partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WINNER = "__winner"


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Keep, per ``keys``, the row with the greatest ``(order_by..., tiebreak...)``.

    ``tiebreak`` defaults to all other columns in their declared order.  The
    output keeps the input's columns and column order.
    """
    keys = list(keys)
    order_by = list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    tiebreak = list(tiebreak) if tiebreak is not None else rest
    payload = [c for c in rest if c not in tiebreak]
    ranked = F.struct(*[F.col(c) for c in order_by + tiebreak + payload])
    winners = df.groupBy(*keys).agg(F.max(ranked).alias(_WINNER))
    return winners.select(*[F.col(k) for k in keys], *[F.col(f"{_WINNER}.{c}").alias(c) for c in order_by + tiebreak + payload]).select(*df.columns)

