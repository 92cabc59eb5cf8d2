"""Session funnel: visit -> cart -> checkout -> purchase, overall and per UTM source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge import schemas as S
from martforge.functions import columns as C


def _counts() -> list:
    return [
        F.count(F.lit(1)).alias("visited"),
        F.count_if(F.col("added_to_cart")).alias("carted"),
        F.count_if(F.col("reached_checkout")).alias("checked_out"),
        F.count_if(F.col("purchased")).alias("purchased"),
    ]


def _rates(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(
        *keys, "visited", "carted", "checked_out", "purchased",
        C.pct("carted", "visited").alias("pct_browse_to_cart"),
        C.pct("checked_out", "carted").alias("pct_cart_to_checkout"),
        C.pct("purchased", "checked_out").alias("pct_checkout_to_purchase"),
        C.pct("purchased", "visited").alias("pct_visit_to_purchase"),
    )


def funnel_overall(fact_sessions: DataFrame) -> DataFrame:
    """One row; a global aggregate (partial counts per task, one tiny final merge)."""
    return _rates(fact_sessions.agg(*_counts()))


def funnel_by_source(fact_sessions: DataFrame) -> DataFrame:
    src = F.coalesce(F.col("utm_source"), F.lit(S.NO_SOURCE_LABEL)).alias("utm_source")
    return _rates(fact_sessions.groupBy(src).agg(*_counts()), "utm_source")


def top_sources(by_source: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` sources with most visits (ties by source name): a top-k, not a sort of everything."""
    return by_source.orderBy(F.col("visited").desc(), F.col("utm_source").asc()).limit(n)
