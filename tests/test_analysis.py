"""Analysis views on tiny hand-made marts, and the registry/entry contract."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martforge.plans import dims
from martforge.plans.analysis import funnel, product, rfm, timeseries
from martforge.sources.store import TableStore
from tests.conftest import rows


def test_segment_matrix_all_125_cells(spark):
    cells = [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    df = spark.createDataFrame(cells, "r int, f int, m int")
    counts = {r["seg"]: r["n"] for r in df.groupBy(rfm.segment_of(F.col("r"), F.col("f"), F.col("m")).alias("seg")).count()
              .withColumnRenamed("count", "n").collect()}
    assert counts == {"Loyal Customers": 26, "Other": 24, "At Risk": 20, "Hibernating": 20, "New Customers": 10,
                      "Promising": 10, "Potential Loyalists": 9, "Champions": 4, "Need Attention": 2}
    assert "Cannot Lose Them" not in counts   # shadowed by "At Risk", evaluated first


def _calendar(spark, lo, hi):
    b = spark.createDataFrame([(lo, hi)], "lo date, hi date")
    return dims.calendar(b)


def _fact(spark, recs):
    return spark.createDataFrame(recs, "order_id long, line_no int, order_date_key int, customer_key long, product_key long, "
                                       "quantity int, net_revenue decimal(12,2), status string")


def test_product_percentile_single_product_and_share(spark):
    marts = {
        "dim_date": _calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31)),
        "dim_product": spark.createDataFrame([(1, 11, "Solo", "Lonely", None), (2, 12, "A", "Pair", None), (3, 13, "B", "Pair", None)],
                                             "product_key long, product_id long, name string, category string, subcategory string"),
        "fact_orders": _fact(spark, [(1, 1, 20240105, 7, 1, 1, Decimal("10.00"), "placed"),
                                     (2, 1, 20240105, 7, 2, 1, Decimal("30.00"), "fulfilled"),
                                     (3, 1, 20240105, 8, 3, 1, Decimal("10.00"), "placed"),
                                     (4, 1, 20240405, 8, 1, 1, Decimal("0.00"), "placed"),
                                     (5, 1, 20240705, 8, 1, 1, Decimal("5.00"), "placed"),
                                     (6, 1, 20240105, 8, 3, 1, Decimal("99.00"), "cancelled")]),
    }
    perf = {(r["product_id"], r["quarter"]): r for r in product.product_performance_q(marts).collect()}
    solo = perf[(11, 1)]
    assert solo["percentile_in_category"] == Decimal("0.00") and solo["pct_of_category"] == Decimal("100.00")
    assert perf[(12, 1)]["rank_in_category"] == 1 and perf[(12, 1)]["percentile_in_category"] == Decimal("100.00")
    assert perf[(12, 1)]["pct_of_category"] == Decimal("75.00")
    assert perf[(11, 2)]["qoq_growth_pct"] == Decimal("-100.00")
    assert perf[(11, 3)]["qoq_growth_pct"] is None       # previous quarter revenue 0 -> NULL, not an error
    assert perf[(11, 3)]["prev_quarter_revenue"] == Decimal("0.00")


def test_trend_rows_vs_calendar_lag(spark):
    # sales on day 1..8 except day 4: lag(7) by rows != same weekday a week earlier
    days = [d for d in range(1, 10) if d != 4]
    recs = [(d, 1, 20240100 + d, 1, 1, 1, Decimal(d), "placed") for d in days]
    marts = {"dim_date": _calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 31)), "fact_orders": _fact(spark, recs)}
    by_rows = {r["full_date"].day: r for r in timeseries.daily_revenue_trend(marts).collect()}
    by_days = {r["full_date"].day: r for r in timeseries.daily_revenue_trend_calendar(marts).collect()}
    assert by_rows[9]["rev_same_dow_lw"] == Decimal("1.00")   # 7 rows back = day 1
    assert by_days[9]["rev_same_dow_lw"] == Decimal("2.00")   # 7 days back = day 2
    assert by_days[4]["net_revenue"] == Decimal("0.00")
    assert by_rows[2]["rev_7d_avg"] == Decimal("1.50")        # partial frame averaged as is


def test_funnel_zero_sessions_gives_null_rates(spark):
    empty = spark.createDataFrame([], "added_to_cart boolean, reached_checkout boolean, purchased boolean, utm_source string")
    r = funnel.funnel_overall(empty).first()
    assert r["visited"] == 0 and r["pct_browse_to_cart"] is None


def test_registry_and_oracle_keys():
    import __spark_entry__ as E
    from martforge.plans.registry import REGISTRY
    q = REGISTRY  # the training-data queries have tests of their own
    assert set(q) <= set(E.queries())
    o = {k: v for k, v in E.oracle_sql().items() if k in q}
    survey_keys = ("raw_load_summary src_csv_landing sink_full_refresh_idempotent sink_insert_if_absent dedup_latest stg_customers "
                   "stg_products stg_orders stg_order_items stg_sessions stg_reject_rows fn_initcap_words fn_parse_money chk_unique "
                   "chk_not_null chk_foreign_key chk_range chk_domain chk_row dim_date_bounds dim_date dim_geography dim_product_scd1 "
                   "scd2_new_customers scd2_changed_customers dim_customer_scd2 asof_customer_join fact_orders fact_sessions dq_orphans "
                   "dq_one_current dq_scd2_overlap dq_revenue_math dq_report first_order_month cohort_sizes cohort_retention "
                   "cohort_retention_recent rfm_scores ntile_distributed rfm_segments rfm_segment_summary funnel_overall "
                   "funnel_by_source funnel_top_sources product_quarter product_performance_q top3_products_latest_q daily_revenue "
                   "daily_revenue_trend daily_trend_last30 customer_ltv ltv_month6").split()
    assert set(survey_keys) <= set(q)
    assert set(o) <= set(q)
    assert set(q) - set(o) == set()


@pytest.mark.slow
def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    out = df.collect()
    assert len(out) > 0 and set(df.columns) >= {"segment", "customers", "pct_of_revenue"}


def test_register_and_export_views(spark):
    import tempfile
    from martforge.plans.analysis.views import export_views, register_views
    from martforge.sources.store import TableStore
    marts = {"fact_sessions": spark.createDataFrame([(True, False, False, "google"), (True, True, True, None)],
                                                    "added_to_cart boolean, reached_checkout boolean, purchased boolean, utm_source string")}
    register_views(marts, ["funnel_overall", "funnel_by_source"])
    assert spark.sql("SELECT visited, carted FROM funnel_overall").first() == (2, 2)
    assert {r[0] for r in spark.sql("SELECT utm_source FROM funnel_by_source").collect()} == {"google", "(none)"}
    store = TableStore(spark, tempfile.mkdtemp(prefix="martforge-views-"))
    export_views(marts, store, ["funnel_overall"])
    assert store.read("analysis.funnel_overall").first()["purchased"] == 1


def test_failed_gate_keeps_previous_version(spark):
    import tempfile
    from martforge.sources.store import TableStore
    store = TableStore(spark, tempfile.mkdtemp(prefix="martforge-store-"))
    good = spark.createDataFrame([(1,)], "x int")
    store.refresh("t", good)
    v1 = store.current_version("t")

    def gate(df):
        if df.where("x < 0").count():
            raise ValueError("gate failed")
    with pytest.raises(ValueError):
        store.refresh("t", spark.createDataFrame([(-1,)], "x int"), gate=gate)
    assert store.current_version("t") == v1 and store.read("t").first()["x"] == 1
    store.refresh("t", spark.createDataFrame([(2,)], "x int"), gate=gate)
    assert store.read("t").first()["x"] == 2


def test_late_order_attaches_to_version_valid_at_order_time(spark):
    """A late-arriving order dated before a customer's move joins the old version on the next full refresh."""
    from martforge.plans import facts
    sig = dt.datetime(2020, 1, 1)
    move = dt.datetime(2021, 1, 1)
    dim_c = spark.createDataFrame([(10, 1, sig, move), (11, 1, move, dt.datetime(9999, 12, 31))],
                                  "customer_key long, customer_id long, effective_from timestamp_ntz, effective_to timestamp_ntz")
    orders = spark.createDataFrame([(100, 1, dt.datetime(2021, 6, 1), "placed", "web", None, Decimal("0.00")),
                                    (101, 1, dt.datetime(2020, 6, 1), "placed", "web", "X", Decimal("0.00"))],   # arrived late
                                   "order_id long, customer_id long, order_ts timestamp_ntz, status string, channel string, "
                                   "discount_code string, shipping_cost decimal(10,2)")
    items = spark.createDataFrame([(100, 1, 5, 2, Decimal("10.00")), (101, 1, 5, 1, Decimal("10.05"))],
                                  "order_id long, line_no int, product_id long, quantity int, unit_price decimal(10,2)")
    prod = spark.createDataFrame([(5, 50)], "product_id long, product_key long")
    got = {r["order_id"]: r for r in facts.fact_orders(orders, items, prod, dim_c).collect()}
    assert got[100]["customer_key"] == 11 and got[101]["customer_key"] == 10
    assert got[101]["discount_amount"] == Decimal("1.01") and got[101]["net_revenue"] == Decimal("9.04")   # 1.005 rounds up


def test_quarters_are_compared_before_attributes_are_joined(spark, monkeypatch):
    facts = spark.createDataFrame([(p, 1, 20200101 + 100 * q, "placed", 10 * p + q, 1) for p in (1, 2, 3) for q in (0, 3, 6)],
                                  "product_key long, customer_key long, order_date_key int, status string, net_revenue int, quantity int")
    dates = spark.createDataFrame([(20200101 + 100 * q, 2020, q // 3 + 1) for q in (0, 3, 6)], "date_key int, year int, quarter int").withColumn("full_date", F.lit(None))
    products = spark.createDataFrame([(p, p, f"n{p}", "c", "s") for p in (1, 2)], "product_key long, product_id long, name string, category string, subcategory string")
    marts = {"fact_orders": facts.withColumn("net_revenue", F.col("net_revenue").cast("decimal(18,2)")), "dim_date": dates, "dim_product": products}
    plans, plain = {}, TableStore.write_version

    def seen(self, name, df, partition_by=None):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
        return plain(self, name, df, partition_by)
    monkeypatch.setattr(TableStore, "write_version", seen)
    got = rows(product.top_products_latest_quarter(marts), "product_id", "quarter", "rank_in_category", "prev_quarter_revenue")
    assert [(a, b, c, int(d)) for a, b, c, d in got] == [(1, 3, 2, 13), (2, 3, 1, 23)]   # a product without a row has none
    depth = {what: next(len(line) - len(line.lstrip(" :+-")) for line in plans["product_quarter"] if f"{what} " in line) for what in ("Window", "Join")}
    assert depth["Join"] < depth["Window"]     # names and categories do not travel with the quarters
