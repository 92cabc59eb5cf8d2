"""The saved analysis views: register them for SQL users, or extract them for BI tools.

Each view is a function of the marts; registering creates Spark temp views
under the warehouse's view names, so ``spark.sql("SELECT * FROM
rfm_segments")`` works as it does against the database.  ``export_views``
writes each view through the versioned store (new version, then pointer
move), which is the hand-off to reporting tools.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from martforge.plans.analysis import cohort, funnel, ltv, product, rfm, timeseries
from martforge.sources.store import TableStore


def view_builders(marts: dict[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """View name -> builder; views that read other views compose the same functions."""
    return {
        "cohort_retention": lambda: cohort.cohort_retention(marts),
        "rfm_segments": lambda: rfm.rfm_segments(marts),
        "funnel_overall": lambda: funnel.funnel_overall(marts["fact_sessions"]),
        "funnel_by_source": lambda: funnel.funnel_by_source(marts["fact_sessions"]),
        "product_performance_q": lambda: product.product_performance_q(marts),
        "daily_revenue": lambda: timeseries.daily_revenue(marts),
        "daily_revenue_trend": lambda: timeseries.daily_revenue_trend(marts),
        "customer_ltv": lambda: ltv.customer_ltv(marts),
    }


def register_views(marts: dict[str, DataFrame], names: list[str] | None = None) -> list[str]:
    """``CREATE OR REPLACE VIEW`` for each analysis view (as Spark temp views)."""
    builders = view_builders(marts)
    chosen = names or list(builders)
    for name in chosen:
        builders[name]().createOrReplaceTempView(name)
    return chosen


def export_views(marts: dict[str, DataFrame], store: TableStore, names: list[str] | None = None) -> dict[str, str]:
    """Publish each view as a Parquet extract; returns view -> published version."""
    builders = view_builders(marts)
    published = {}
    for name in names or list(builders):
        version = store.write_version(f"analysis.{name}", builders[name]())
        store.publish(f"analysis.{name}", version)
        published[name] = version
    return published
