"""Snapshots of a versioned (SCD2) dimension in any order of arrival.

``scd2.scd2_apply`` takes snapshots in the order of their times.  One that arrives late
must cut the version that was valid at its time, and what an in-between snapshot only
confirmed then decides where the old values resume; the versions alone do not tell.  So
every snapshot's rows also go into a log (one row per key and time).  A snapshot splits:

* keys without a later row in the log take the ordinary full-outer join of ``scd2_apply``;
* keys with one are late: their versions are rebuilt from their rows of the log, and
  replace what the dimension holds of them.

The log is read with a bound on its time, so files of older snapshots are skipped; only
late keys are looked up in all of it.  The window of a rebuild holds one key's snapshots,
whose number is that of the loads.  Any order of arrival gives the dimension that the order
of times gives.

The first row of a (key, time) stays: a snapshot that comes twice changes nothing.  Keys are
not NULL; tracked columns may be (compared null-safely).  Empty snapshots change nothing.
The log must hold every snapshot the dimension was built from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge import schemas as S
from martforge.operators.keys import surrogate_key
from martforge.operators.scd2 import _ts, scd2_apply

OBSERVED = "observed_at"


def versions_of(log: DataFrame, columns: Sequence[str], *, natural_key: str, tracked: Sequence[str], first_from: str,
                surrogate: str = "version_key", valid_from: str = "effective_from", valid_to: str = "effective_to",
                current_flag: str = "is_current") -> DataFrame:
    """The versions, with ``columns``, that the rows of ``log`` make in the order of their times."""
    by_time = Window.partitionBy(natural_key).orderBy(OBSERVED)
    values = F.struct(*tracked)
    seen = log.withColumn("__before", F.lag(values).over(by_time)).withColumn("__first", F.row_number().over(by_time) == 1)
    starts = seen.where(F.col("__first") | ~F.col("__before").eqNullSafe(values))
    starts = starts.withColumn("__next", F.lead(OBSERVED).over(by_time))
    since = F.when(F.col("__first"), F.col(first_from)).otherwise(F.col(OBSERVED))
    made = {
        valid_from: since,
        valid_to: F.coalesce(F.col("__next"), _ts(S.OPEN_END)),
        current_flag: F.col("__next").isNull(),
        surrogate: surrogate_key(F.col(natural_key), since),
    }
    return starts.select(*[made.get(c, F.col(c)).alias(c) for c in columns])


def splice(dim: DataFrame, log: DataFrame, incoming: DataFrame, run_ts, *, natural_key: str, tracked: Sequence[str],
           first_from: str, **names) -> tuple[DataFrame, DataFrame]:
    """(dimension, log) after the snapshot ``incoming`` of time ``run_ts``.

    ``log`` has the columns of ``incoming`` and ``observed_at``; ``names`` are those of ``scd2_apply``.
    """
    run = _ts(run_ts)
    fresh = incoming.join(log.where(F.col(OBSERVED) == run).select(natural_key), natural_key, "left_anti")
    late = fresh.select(natural_key).join(log.where(F.col(OBSERVED) > run).select(natural_key), natural_key, "left_semi")
    rules = dict(natural_key=natural_key, tracked=tracked, first_from=first_from, **names)
    new_log = log.unionByName(fresh.withColumn(OBSERVED, run))
    in_order = scd2_apply(dim.join(late, natural_key, "left_anti").select(*dim.columns),
                          fresh.join(late, natural_key, "left_anti"), run_ts, **rules)
    rebuilt = versions_of(new_log.join(late, natural_key, "left_semi"), dim.columns, **rules)
    return in_order.unionByName(rebuilt), new_log
