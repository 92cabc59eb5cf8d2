"""Pipeline data-quality gate: seven assertions over the marts.

``dq_report`` evaluates every check and returns ``(check_id, check, n_bad,
passed)``; ``dq_enforce`` raises after evaluating all of them (the source
warehouse stops at the first failure; reporting all is strictly more useful
and gates publication the same way).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.operators import checks

CHECK_NAMES = {
    1: "order lines whose customer version is missing",
    2: "order lines whose product is missing",
    3: "customers with no or several current versions",
    4: "pairs of versions valid at the same time",
    5: "order lines whose net differs from gross less discount",
    6: "order lines with a quantity or price out of range",
    7: "versions that end before they begin",
}


def _one(check_id: int, n_bad: DataFrame) -> DataFrame:
    return n_bad.select(F.lit(check_id).alias("check_id"), F.lit(CHECK_NAMES[check_id]).alias("check"),
                        F.col("n_bad").cast("long").alias("n_bad"))


def orphan_count(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Fact rows whose key finds no dimension row (a NULL key is an orphan too)."""
    return fact.select(F.col(fact_key).alias("__k")).join(dim.select(F.col(dim_key).alias("__k")), "__k", "left_anti") \
        .agg(F.count(F.lit(1)).alias("n_bad"))


def one_current_violations(dim: DataFrame, natural_key: str = "customer_id", current_flag: str = "is_current") -> DataFrame:
    """Entities whose number of current versions is not exactly one."""
    return dim.groupBy(natural_key).agg(F.count_if(F.col(current_flag)).alias("n_current")).where("n_current <> 1")


def overlapping_pairs(dim: DataFrame, natural_key: str = "customer_id", version_key: str = "customer_key",
                      valid_from: str = "effective_from", valid_to: str = "effective_to") -> DataFrame:
    """Number of ordered pairs (a, b), a != b, same entity, with a.from < b.to and b.from < a.to.

    Same count as the pairwise self-join, computed by a sweep instead of
    emitting pairs: for every version a,
      N(a) = #{b: b.from < a.to} - #{b: b.to <= a.from} + Z(a) - [a.from < a.to]
    where Z(a) counts zero-length versions sitting exactly on a zero-length a.
    The two counts are running sums over one stream of 2 events per version
    ordered by (time, event order), so the cost is a sort per entity, linear
    in its versions (a pathological entity with millions of versions is a
    long sorted scan, not a quadratic join).

    The sums hold for versions with from <= to.  Versions that end before they
    begin (see ``inverted_windows``) are errors and few; they stay out of the
    sweep, and only their own overlaps are found by a join on the entity.
    """
    k, f, t = natural_key, valid_from, valid_to
    inverted = dim.where(F.col(f) > F.col(t)).select(F.col(k).alias("k"), F.col(version_key).alias("v1"), F.col(f).alias("f1"), F.col(t).alias("t1"))
    every = dim.select(F.col(k).alias("k"), F.col(version_key).alias("v2"), F.col(f).alias("f2"), F.col(t).alias("t2"))
    odd = inverted.join(every, "k").where((F.col("v1") != F.col("v2")) & (F.col("f1") < F.col("t2")) & (F.col("f2") < F.col("t1")))
    # an inverted version and a proper one make two ordered pairs, two inverted ones are met from both sides
    odd = odd.select(F.when(F.col("f2") > F.col("t2"), 1).otherwise(2).cast("long").alias("v"))
    dim = dim.where(F.col(f) <= F.col(t))
    events = dim.select(
        F.col(k).alias("k"),
        F.explode(F.array(
            F.struct(F.col(f).alias("t"), F.lit(1).alias("ord"), F.lit(1).alias("fw"), F.lit(0).alias("tw")),
            F.struct(F.col(t).alias("t"), F.lit(0).alias("ord"), F.lit(0).alias("fw"), F.lit(1).alias("tw")),
        )).alias("e"),
    ).select("k", "e.*")
    w = Window.partitionBy("k").orderBy("t", "ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = events.select("ord", F.sum("fw").over(w).alias("run_from"), F.sum("tw").over(w).alias("run_to"))
    # N = S1 - S2 + Z - P, summed as signed per-row contributions in one aggregate
    s = swept.select(F.when(F.col("ord") == 0, F.col("run_from")).otherwise(-F.col("run_to")).cast("long").alias("v"))
    zero = dim.where(F.col(f) == F.col(t)).groupBy(k, f).agg(F.count(F.lit(1)).alias("m")).select((F.col("m") * F.col("m")).cast("long").alias("v"))
    proper = dim.where(F.col(f) < F.col(t)).select(F.lit(-1).cast("long").alias("v"))
    return s.unionByName(zero).unionByName(proper).unionByName(odd).agg(F.coalesce(F.sum("v"), F.lit(0)).cast("long").alias("n_bad"))


def inverted_windows(dim: DataFrame, valid_from: str = "effective_from", valid_to: str = "effective_to") -> DataFrame:
    return dim.agg(F.count_if(F.col(valid_from) > F.col(valid_to)).alias("n_bad"))


def dq_report(fact_orders: DataFrame, dim_customer: DataFrame, dim_product: DataFrame) -> DataFrame:
    """All seven checks; one row each.  Q5 and Q6 share one scan of the fact."""
    math = fact_orders.agg(
        F.count_if(F.round("net_revenue", 2) != F.round(F.col("gross_revenue") - F.col("discount_amount"), 2)).alias("q5"),
        F.count_if((F.col("quantity") <= 0) | (F.col("unit_price") < 0)).alias("q6"),
    )
    parts = [
        _one(1, orphan_count(fact_orders, "customer_key", dim_customer, "customer_key")),
        _one(2, orphan_count(fact_orders, "product_key", dim_product, "product_key")),
        _one(3, one_current_violations(dim_customer).agg(F.count(F.lit(1)).alias("n_bad"))),
        _one(4, overlapping_pairs(dim_customer)),
        _one(7, inverted_windows(dim_customer)),
        math.select(F.explode(F.array(F.struct(F.lit(5).alias("check_id"), F.lit(CHECK_NAMES[5]).alias("check"), F.col("q5").cast("long").alias("n_bad")),
                                      F.struct(F.lit(6).alias("check_id"), F.lit(CHECK_NAMES[6]).alias("check"), F.col("q6").cast("long").alias("n_bad")))).alias("x")).select("x.*"),
    ]
    report = checks.union_reports(parts)
    return report.withColumn("passed", F.col("n_bad") == 0)


def dq_enforce(report: DataFrame) -> DataFrame:
    """Raise ``ValueError`` naming every failed check; returns the report otherwise."""
    rows = report.orderBy("check_id").collect()
    failed = [r for r in rows if not r["passed"]]
    if failed:
        raise ValueError("; ".join(f"DQ FAIL: {r['n_bad']} {r['check']}" for r in failed))
    return report
