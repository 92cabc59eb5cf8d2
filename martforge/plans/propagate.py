"""Late orders, changed orders and changed customer versions reach the monthly order fact, month by month.

From the staging tables and customer versions before and after a load follows the set of
orders whose fact lines can differ: orders or lines that were added, dropped or changed,
and orders of a customer placed on or after the first moment at which the customer's
versions differ.  Their months, before and after, are recomputed and published; every
other month keeps its files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions import columns as C
from martforge.plans import facts
from martforge.sources.monthly import MonthlyTable, month_of


def _differing(before: DataFrame, after: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of the rows that only one side has (rows are told apart by a hash of all columns)."""
    cols = before.columns
    sides = before.withColumn("__side", F.lit(1)).unionByName(after.select(*cols).withColumn("__side", F.lit(-1)))
    return sides.groupBy(*cols).agg(F.sum("__side").alias("__n")).where("__n <> 0").select(*keep)


def first_version_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(customer_id, changed_from)``: the first moment at which a customer's versions differ.

    A version that is only on one side matters from its start, one whose end moved from the earlier end.
    """
    cols = ["customer_id", "customer_key", "effective_from", "effective_to"]
    odd = _differing(before.select(*cols), after.select(*cols), cols)
    both = odd.groupBy("customer_id", "customer_key", "effective_from").agg(F.count(F.lit(1)).alias("n"), F.min("effective_to").alias("end"))
    return both.select("customer_id", F.when(F.col("n") == 2, F.col("end")).otherwise(F.col("effective_from")).alias("t")) \
        .groupBy("customer_id").agg(F.min("t").alias("changed_from"))


def affected_months(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> list[int]:
    """Months (YYYYMM) whose order facts can differ between two states of ``orders``, ``order_items`` and ``dim_customer``."""
    moved = _differing(before["orders"], after["orders"], ["order_ts"])
    lines = _differing(before["order_items"], after["order_items"], ["order_id"]).distinct()
    orders = before["orders"].select("order_id", "customer_id", "order_ts").unionByName(after["orders"].select("order_id", "customer_id", "order_ts"))
    changed = first_version_change(before["dim_customer"], after["dim_customer"])
    due = moved.unionByName(orders.join(lines, "order_id", "left_semi").select("order_ts")) \
        .unionByName(orders.join(changed, "customer_id").where("order_ts >= changed_from").select("order_ts"))
    rows = due.select(month_of(C.date_key("order_ts")).alias("m")).distinct().collect()   # as many as there are months
    return sorted(r["m"] for r in rows)


def propagate(table: MonthlyTable, before: dict[str, DataFrame], after: dict[str, DataFrame], dim_product: DataFrame) -> list[int]:
    """Recompute and publish the affected months of the order fact; returns them.

    Only orders of these months are read into the fact, and lines are cut to those orders before any other join.
    """
    months = affected_months(before, after)
    if months:
        orders = after["orders"].where(month_of(C.date_key("order_ts")).isin(months))
        items = after["order_items"].join(orders.select("order_id"), "order_id", "left_semi")
        table.write(facts.fact_orders(orders, items, dim_product, after["dim_customer"]), months)
    return months
