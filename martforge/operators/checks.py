"""Table constraints as checks.

The source warehouse relies on the database to reject a load that breaks a
primary key, NOT NULL, foreign key or CHECK constraint.  Spark enforces none
of them, so each is a function returning a one-row-per-check report
``(check, subject, n_bad)``; ``violations_*`` variants return offending rows.
Every check is a single distributed pass (aggregate or anti-join); counts of
violations are the only thing that reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_COLUMNS = ("check", "subject", "n_bad")


def _report(check: str, subject: str, n_bad_df: DataFrame) -> DataFrame:
    return n_bad_df.select(F.lit(check).alias("check"), F.lit(subject).alias("subject"), F.col("n_bad").cast("long"))


def violations_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row counts (NULL keys included as a group)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def unique(df: DataFrame, keys: Sequence[str], table: str = "") -> DataFrame:
    """PRIMARY KEY / UNIQUE: rows sharing a key with another row, plus rows with a NULL key part.

    A UNIQUE constraint admits several NULL keys while a PRIMARY KEY admits
    none; both are reported here (``n_bad`` counts rows).
    """
    keys = list(keys)
    null_key = None
    for k in keys:
        null_key = F.col(k).isNull() if null_key is None else (null_key | F.col(k).isNull())
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.max(null_key.cast("int")).alias("has_null"))
    bad = per_key.agg(F.coalesce(F.sum(F.when((F.col("n_rows") > 1) | (F.col("has_null") == 1), F.col("n_rows"))), F.lit(0)).alias("n_bad"))
    return _report("unique", f"{table}({', '.join(keys)})", bad)


def not_null(df: DataFrame, columns: Iterable[str], table: str = "") -> DataFrame:
    """NOT NULL on several columns in one pass; one report row per column."""
    columns = list(columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    stacked = counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).alias("n_bad")) for c in columns])).alias("x"))
    return stacked.select(F.lit("not_null").alias("check"), F.concat(F.lit(f"{table}."), F.col("x.col")).alias("subject"),
                          F.col("x.n_bad").cast("long").alias("n_bad"))


def violations_foreign_key(child: DataFrame, child_key: Sequence[str], parent: DataFrame, parent_key: Sequence[str]) -> DataFrame:
    """Child rows whose non-NULL reference has no parent row."""
    child_key, parent_key = list(child_key), list(parent_key)
    present = None
    for k in child_key:
        present = F.col(k).isNotNull() if present is None else (present & F.col(k).isNotNull())
    p = parent.select(*[F.col(pk).alias(ck) for pk, ck in zip(parent_key, child_key)])
    return child.where(present).join(p, on=child_key, how="left_anti")


def foreign_key(child: DataFrame, child_key: Sequence[str], parent: DataFrame, parent_key: Sequence[str],
                child_table: str = "", parent_table: str = "") -> DataFrame:
    bad = violations_foreign_key(child, child_key, parent, parent_key).agg(F.count(F.lit(1)).alias("n_bad"))
    return _report("foreign_key", f"{child_table}({', '.join(child_key)}) -> {parent_table}({', '.join(parent_key)})", bad)


def condition(df: DataFrame, predicate: str, check: str, subject: str) -> DataFrame:
    """CHECK (predicate): rows where the predicate is FALSE (NULL passes, as in SQL)."""
    bad = df.agg(F.count_if(~F.expr(predicate)).alias("n_bad"))
    return _report(check, subject, bad)


def ranges(df: DataFrame, bounds: Mapping[str, str], table: str = "") -> DataFrame:
    """Range CHECKs such as ``{"quantity": "> 0"}`` in one pass."""
    counts = df.agg(*[F.count_if(~F.expr(f"{c} {b}")).alias(c) for c, b in bounds.items()])
    stacked = counts.select(F.explode(F.array(*[F.struct(F.lit(f"{table}.{c} {b}").alias("subject"), F.col(c).alias("n_bad"))
                                                  for c, b in bounds.items()])).alias("x"))
    return stacked.select(F.lit("range").alias("check"), F.col("x.subject"), F.col("x.n_bad").cast("long").alias("n_bad"))


def domain(df: DataFrame, column: str, allowed: Sequence[str], table: str = "") -> DataFrame:
    """CHECK (column IN (...)); NULL passes."""
    bad = df.agg(F.count_if(~F.col(column).isin(*allowed)).alias("n_bad"))
    return _report("domain", f"{table}.{column}", bad)


def row_rule(df: DataFrame, predicate: str, table: str = "") -> DataFrame:
    return condition(df, predicate, "row", f"{table}: {predicate}")


def union_reports(reports: Sequence[DataFrame]) -> DataFrame:
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


def enforce(report: DataFrame) -> DataFrame:
    """Raise if any check in the report failed (after evaluating all of them).

    Collects the report, which has one row per check.
    """
    rows = report.collect()
    failed = [r for r in rows if r["n_bad"] and r["n_bad"] > 0]
    if failed:
        detail = "; ".join(f"{r['check']} {r['subject']}: {r['n_bad']}" for r in failed)
        raise ValueError(f"constraint check failed: {detail}")
    return report
