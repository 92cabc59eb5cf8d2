"""Table contracts enforced while a table is written.

NOT NULL, range, domain and row rules hold or fail for one row at a time, so they are
counted by the write itself: the rules become aggregates observed on the rows as they
pass into the files (``DataFrame.observe``), and no second scan is needed.  Keys and
references look across rows or tables; they read the key columns of the written
version.  All violations of a build are gathered before anything is decided.

A task that Spark runs again may be observed again, so a non-zero count can be too
high; zero is exact, and the verdict only asks for zero.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martforge.operators import checks
from martforge.sources.store import TableStore

REPORT = "check string, subject string, n_bad long"


class Violations(NamedTuple):
    check: str
    subject: str
    n_bad: int


class ContractError(ValueError):
    """A build broke its contract; ``violations`` holds every rule that failed."""

    def __init__(self, violations: list[Violations]):
        self.violations = violations
        super().__init__("contract broken: " + "; ".join(f"{v.check} {v.subject}: {v.n_bad}" for v in violations))


def row_rules(table: str, contract: Mapping) -> list[tuple[str, str, Column]]:
    """(check, subject, whether a row breaks it) of every rule that needs one row only; NULL passes a CHECK."""
    rules = [("not_null", f"{table}.{c}", F.col(c).isNull()) for c in contract.get("not_null", ())]
    rules += [("range", f"{table}.{c} {bound}", ~F.expr(f"{c} {bound}")) for c, bound in contract.get("range", {}).items()]
    rules += [("domain", f"{table}.{c}", ~F.col(c).isin(*allowed)) for c, allowed in contract.get("domain", {}).items()]
    rules += [("row", f"{table}: {rule}", ~F.expr(rule)) for rule in contract.get("row", ())]
    return rules


def write_observed(store: TableStore, name: str, df: DataFrame, table: str, contract: Mapping,
                   partition_by: list[str] | None = None) -> tuple[str, DataFrame, list[Violations]]:
    """Write a new, unpublished version of ``name``: (version, the written table, counts of its row rules)."""
    rules = row_rules(table, contract)
    watch = Observation(f"contract of {name}")
    watched = df.observe(watch, F.count(F.lit(1)).alias("rows"), *[F.count_if(bad).alias(f"r{i}") for i, (_, _, bad) in enumerate(rules)])
    version = store.write_version(name, watched, partition_by)
    found = watch.get  # empty where the plan was proven to have no rows
    counts = [Violations(check, subject, int(found.get(f"r{i}") or 0)) for i, (check, subject, _) in enumerate(rules)]
    return version, store.read(name, version, schema=df.schema), counts


def key_report(tables: Mapping[str, DataFrame], contracts: Mapping[str, Mapping]) -> DataFrame:
    """``(check, subject, n_bad)`` of all keys and references between ``tables``."""
    reports = [checks.unique(tables[t], keys, t) for t, c in contracts.items() for keys in c.get("unique", ())]
    reports += [checks.foreign_key(tables[t], ck, tables[p], pk, t, p) for t, c in contracts.items() for ck, p, pk in c.get("foreign_keys", ())]
    return checks.union_reports(reports)


def report_frame(spark: SparkSession, counts: list[Violations]) -> DataFrame:
    return spark.createDataFrame([tuple(v) for v in counts], REPORT)


def broken(counts: list[Violations]) -> list[Violations]:
    return [v for v in counts if v.n_bad]
