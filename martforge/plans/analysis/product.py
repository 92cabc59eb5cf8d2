"""Product x quarter performance: revenue, units, buyers, rank and share in
category, percentile, quarter-over-quarter growth; top-3 per category."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.functions import columns as C
from martforge.operators.ranking import group_ranks
from martforge.plans.analysis.common import dated_revenue_facts
from martforge.sources.store import TableStore


def _by_quarter(marts: dict[str, DataFrame]) -> DataFrame:
    """Measures per product key and calendar quarter (placed/fulfilled lines), without the product's attributes."""
    f = dated_revenue_facts(marts["fact_orders"], marts["dim_date"], ["product_key", "customer_key", "net_revenue", "quantity"])
    return f.groupBy("product_key", "year", "quarter").agg(
        F.sum("net_revenue").cast("decimal(18,2)").alias("net_revenue"),
        F.sum("quantity").cast("long").alias("units_sold"),
        F.count_distinct("customer_key").cast("long").alias("unique_buyers"),
    )


def _described(agg: DataFrame, marts: dict[str, DataFrame]) -> DataFrame:
    p = marts["dim_product"].select("product_key", "product_id", F.col("name").alias("product_name"), "category", "subcategory")
    measures = [c for c in agg.columns if c not in ("product_key", "year", "quarter")]
    return agg.join(p, "product_key").select("product_key", "product_id", "product_name", "category", "subcategory", "year", "quarter", *measures)


def product_quarter(marts: dict[str, DataFrame]) -> DataFrame:
    """Per product and calendar quarter (placed/fulfilled lines).

    Aggregation happens on the fact's keys first; product attributes are
    joined to the (much smaller) aggregate, not to every line.
    """
    return _described(_by_quarter(marts), marts)


def _with_previous(agg: DataFrame) -> DataFrame:
    """The quarters travel as numbers only: attributes are joined after this exchange."""
    prev = F.lag("net_revenue").over(Window.partitionBy("product_key").orderBy("year", "quarter"))   # <= one row per quarter
    return agg.withColumn("prev_quarter_revenue", prev)


def _ranked(pq: DataFrame) -> DataFrame:
    """Rank, share and percentile within (category, year, quarter) by ``operators.ranking.group_ranks``: a category may be of any size."""
    pq = TableStore(pq.sparkSession).materialize("product_quarter", pq)   # the aggregate of all fact lines is made once
    ranked = group_ranks(pq, ["category", "year", "quarter"], "net_revenue")
    base = ranked.select(
        *[c for c in pq.columns if c != "prev_quarter_revenue"],
        F.col("dense_rank_desc").alias("rank_in_category"),
        C.pct("net_revenue", "group_total").alias("pct_of_category"),
        F.coalesce(C.pct(F.col("rank_asc") - 1, F.col("group_rows") - 1), F.lit(0).cast("decimal(18,2)")).alias("percentile_in_category"),
        "prev_quarter_revenue",
    )
    return base.withColumn("qoq_growth_pct", C.growth_pct("net_revenue", "prev_quarter_revenue"))


def product_performance_q(marts: dict[str, DataFrame]) -> DataFrame:
    """Rank, share and percentile within (category, year, quarter); QoQ growth per product."""
    return _ranked(_described(_with_previous(_by_quarter(marts)), marts))


def latest_quarter(marts: dict[str, DataFrame]) -> tuple[int, int] | None:
    """(year, quarter) of the latest placed/fulfilled sale: one scalar job."""
    f = dated_revenue_facts(marts["fact_orders"], marts["dim_date"], [])
    row = f.agg(F.max(F.col("year").cast("int") * 10 + F.col("quarter").cast("int")).alias("yq")).first()
    return None if row is None or row["yq"] is None else divmod(row["yq"], 10)


def top_products_latest_quarter(marts: dict[str, DataFrame], k: int = 3) -> DataFrame:
    """Rank <= k per category in the latest (year, quarter); dense rank, so ties may add rows.

    Growth needs the quarter before, so the lag runs first; only the latest quarter is ranked.
    """
    agg = _with_previous(_by_quarter(marts))
    latest = latest_quarter(marts)
    here = F.lit(False) if latest is None else (F.col("year") == latest[0]) & (F.col("quarter") == latest[1])
    return _ranked(_described(agg.where(here), marts)).where(F.col("rank_in_category") <= k)
