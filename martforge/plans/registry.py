"""Named queries over the fixture warehouse: ``name -> (spark, sf_dir) -> DataFrame``.

Outputs identify rows by natural keys (customer_id + version start, product_id)
instead of hash surrogates, so an independent SQL engine can reproduce them.
"""

from __future__ import annotations

import datetime as dt
import functools
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge import schemas as S
from martforge.operators import checks, contracts, quality
from martforge.operators.dedup import dedup_latest
from martforge.operators.joins import asof_window_join
from martforge.operators.keys import assign_keys
from martforge.operators.ranking import ntile_distributed
from martforge.operators.scd2 import scd2_changes, scd2_new
from martforge.plans import dims, facts, propagate, quarantine, staging
from martforge.plans.analysis import cohort, funnel, ltv, product, rfm, timeseries
from martforge.plans.warehouse import landed, warehouse
from martforge.session import apply_bounded_tasks_conf
from martforge.sources import fixtures, landing
from martforge.sources.monthly import MonthlyTable
from martforge.sources.store import TableStore
from martforge.functions import columns as C

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        apply_bounded_tasks_conf(spark)
        return fn(spark, sf)
    REGISTRY[fn.__name__] = run
    return run


def _marts(spark, sf):
    return warehouse(spark, sf).marts()


def _versions(spark, sf) -> DataFrame:
    """customer_key -> (customer_id, effective_from): natural identity of a version."""
    return _marts(spark, sf)["dim_customer"].select("customer_key", "customer_id", F.col("effective_from").alias("customer_effective_from"))


def _naturalise(df: DataFrame, spark, sf) -> DataFrame:
    """Replace customer_key by (customer_id, customer_effective_from)."""
    return df.join(_versions(spark, sf), "customer_key", "left").drop("customer_key")


def _with_geography(df: DataFrame, spark, sf) -> DataFrame:
    geo = _marts(spark, sf)["dim_geography"]
    return df.join(geo, "geography_key", "left").drop("geography_key")


# --- sources / sinks -------------------------------------------------------------
def _raw(spark, sf, run: int = 1) -> dict[str, DataFrame]:
    """The landed raw feeds of a fixture load (written once by the warehouse build)."""
    w = warehouse(spark, sf)
    return {feed: w[f"run{run}.raw.{feed}"] for feed in S.FEEDS}


@query
def raw_load_summary(spark, sf):
    return landing.raw_load_summary(_raw(spark, sf))


@query
def src_csv_landing(spark, sf):
    """Round trip of the orders feed through CSV files and the strict landing reader."""
    store = TableStore(spark)
    raw = fixtures.raw_orders(spark, sf)
    path = f"{store.root}/csv-landing/{spark.sparkContext.applicationId}-{abs(hash(sf))}/orders.csv"
    landing.write_feed_csv(raw, path, "orders", mode="overwrite")
    return landing.read_feed(spark, path, "orders", fixtures.RUN_TS_1, multiline=True)


@query
def src_csv_landing_all(spark, sf):
    """All five feeds through CSV files and one ``land`` call: the landed rows, as records per feed and load time."""
    base = f"{TableStore(spark).root}/csv-landing-all/{spark.sparkContext.applicationId}-{abs(hash(sf))}"
    for feed, raw in _raw(spark, sf).items():
        landing.write_feed_csv(raw, f"{base}/{feed}.csv", feed, mode="overwrite")
    out = None
    for feed, df in landing.land(spark, base, fixtures.RUN_TS_1).items():
        record = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("\\N")) for c in S.RAW_COLUMNS[feed]])
        part = df.select(F.lit(feed).alias("feed"), record.alias("record"), "loaded_at")
        out = part if out is None else out.unionByName(part)
    return out


@query
def incremental_orders_load(spark, sf):
    """Orders arrive in two drops (up to 1997, then the rest); each drop is merged by a
    streaming incremental run; staging the merged raw table equals a full reload."""
    from martforge.streaming.incremental import run_incremental_load
    store = TableStore(spark)
    base = f"{store.root}/incremental/{spark.sparkContext.applicationId}-{abs(hash(sf))}"
    raw = fixtures.raw_orders(spark, sf)
    year = F.substring("order_ts", 1, 4).cast("int")
    latest = None
    for drop in (year <= 1997, year > 1997):
        landing.write_feed_csv(raw.where(drop), f"{base}/landing", "orders")
        latest = run_incremental_load(spark, "orders", f"{base}/landing", f"incremental-orders-{abs(hash(base))}",
                                      f"{base}/checkpoint", store)
    return staging.stage_orders(latest, _stg(spark, sf, "customers"))


@query
def streaming_daily_funnel(spark, sf):
    """Daily funnel over sessions built by a Structured Streaming run over the event files."""
    from martforge.streaming.funnel import daily_funnel, run_session_stream
    store = TableStore(spark)
    base = f"{store.root}/stream-sessions/{spark.sparkContext.applicationId}-{abs(hash(sf))}"
    # a glob, so the stream source watches the folder for event files
    sessions = run_session_stream(spark, f"{sf.rstrip('/')}/event[s].parquet", f"stream-sessions-{abs(hash(base))}",
                                  f"{base}/checkpoint", store)
    return daily_funnel(sessions)


@query
def sink_full_refresh_idempotent(spark, sf):
    """fact_orders refreshed twice through the versioned store; the published version is read."""
    store = TableStore(spark)
    name = f"refresh-{spark.sparkContext.applicationId}-{abs(hash(sf))}"
    fo = _marts(spark, sf)["fact_orders"]
    store.refresh(name, fo)
    store.refresh(name, fo)
    return fact_orders_natural(store.read(name), spark, sf)


@query
def sink_insert_if_absent(spark, sf):
    """dim_geography after both runs (second run only appends new triples)."""
    return _marts(spark, sf)["dim_geography"].select("country", "region", "city")


# --- staging ---------------------------------------------------------------------
@query
def dedup_latest_items(spark, sf):
    raw = _raw(spark, sf)["order_items"]
    keyed = raw.select(F.col("order_id").cast("bigint").alias("k_order_id"), F.col("line_no").cast("int").alias("k_line_no"), *raw.columns)
    out = dedup_latest(keyed, ["k_order_id", "k_line_no"], ["loaded_at"], tiebreak=list(S.RAW_COLUMNS["order_items"]))
    return out.select(F.col("k_order_id").alias("order_id"), F.col("k_line_no").alias("line_no"),
                      "product_id", "quantity", "unit_price", "loaded_at")


def _stg(spark, sf, name):
    return warehouse(spark, sf)[f"staging.{name}"]


@query
def stg_customers(spark, sf):
    return _stg(spark, sf, "customers")


@query
def stg_products(spark, sf):
    return _stg(spark, sf, "products")


@query
def stg_orders(spark, sf):
    return _stg(spark, sf, "orders")


@query
def stg_order_items(spark, sf):
    return _stg(spark, sf, "order_items")


@query
def stg_sessions(spark, sf):
    return _stg(spark, sf, "sessions")


_ROUTED: dict[tuple[str, str], dict[str, DataFrame]] = {}
_ROUTE_LOCK = threading.Lock()


def _landed(spark, sf) -> dict[str, DataFrame]:
    """The raw feeds of the first load, as landed: bad rows are set aside there, so no build must pass its contract first."""
    return landed(spark, sf)[0][0]


def _routed(spark, sf) -> dict[str, DataFrame]:
    """The planted feeds, routed once per application."""
    key = (spark.sparkContext.applicationId, sf.rstrip("/"))
    with _ROUTE_LOCK:
        if key not in _ROUTED:
            _ROUTED[key] = quarantine.route_all(fixtures.planted_feeds(_landed(spark, sf)))
        return _ROUTED[key]


@query
def stg_reject_rows(spark, sf):
    """Rows that staging sets aside, with feed, reason and raw record, from feeds with planted bad rows."""
    return quarantine.rejects(_routed(spark, sf))


@query
def stg_reject_summary(spark, sf):
    """Counts of rejected rows per feed and reason, in the feeds as they are."""
    return quarantine.reject_summary(_landed(spark, sf))


@query
def stg_reject_accounting(spark, sf):
    return quarantine.accounting(_routed(spark, sf))


@query
def stg_accepted_order_items(spark, sf):
    """Lines staged from the accepted rows of the planted feeds."""
    return quarantine.accepted_rows(_routed(spark, sf), "order_items")


@query
def fn_initcap_words(spark, sf):
    p = fixtures.read_table(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("product_id"), C.initcap_words("p_type").alias("category"),
                    C.initcap_words("p_brand").alias("subcategory"), C.initcap_words("p_name").alias("name_title"))


@query
def fn_parse_money(spark, sf):
    li = fixtures.read_table(spark, sf, "lineitem")
    text = fixtures.money_text(F.col("l_extendedprice"))
    return li.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
                     text.alias("price_text"), C.parse_money(text).alias("price"))


# --- constraints -------------------------------------------------------------------
def _stg_all(spark, sf):
    return {k: _stg(spark, sf, k) for k in S.FEEDS}


@query
def chk_unique(spark, sf):
    t = _stg_all(spark, sf)
    return checks.union_reports([checks.unique(t[n], keys, n) for n, c in S.STAGING_CONTRACTS.items() for keys in c["unique"]])


@query
def chk_not_null(spark, sf):
    t = _stg_all(spark, sf)
    return checks.union_reports([checks.not_null(t[n], c["not_null"], n) for n, c in S.STAGING_CONTRACTS.items()])


@query
def chk_foreign_key(spark, sf):
    t = _stg_all(spark, sf)
    return checks.union_reports([checks.foreign_key(t[n], ck, t[p], pk, n, p)
                                 for n, c in S.STAGING_CONTRACTS.items() for ck, p, pk in c.get("foreign_keys", [])])


@query
def chk_range(spark, sf):
    t = _stg_all(spark, sf)
    return checks.union_reports([checks.ranges(t[n], c["range"], n) for n, c in S.STAGING_CONTRACTS.items() if "range" in c])


@query
def chk_domain(spark, sf):
    t = _stg_all(spark, sf)
    return checks.union_reports([checks.domain(t[n], col, allowed, n)
                                 for n, c in S.STAGING_CONTRACTS.items() for col, allowed in c.get("domain", {}).items()])


@query
def chk_row(spark, sf):
    t = _stg_all(spark, sf)
    return checks.union_reports([checks.row_rule(t[n], rule, n) for n, c in S.STAGING_CONTRACTS.items() for rule in c.get("row", ())])


@query
def chk_marts_contract(spark, sf):
    """The report of the build: row rules as counted by the writes, keys and references on the written marts."""
    return warehouse(spark, sf)["checks.marts"]


@query
def chk_marts_planted(spark, sf):
    """The same contract on marts with planted bad rows; the row rules are counted while the tables are written."""
    store = TableStore(spark)
    base = f"planted-{spark.sparkContext.applicationId}-{abs(hash(sf))}"
    written, counts = {}, []
    for table, df in fixtures.planted_marts(_marts(spark, sf)).items():
        _, written[table], found = contracts.write_observed(store, f"{base}.{table}", df, table, S.MART_CONTRACTS[table])
        counts += found
    return contracts.report_frame(spark, counts).unionByName(contracts.key_report(written, S.MART_CONTRACTS))


# --- dimensions ----------------------------------------------------------------------
@query
def dim_date_bounds(spark, sf):
    s = _stg_all(spark, sf)
    return dims.date_bounds(s["customers"], s["orders"], s["sessions"])


@query
def dim_date(spark, sf):
    return _marts(spark, sf)["dim_date"]


@query
def dim_geography(spark, sf):
    return warehouse(spark, sf)["run1.marts.dim_geography"].select("country", "region", "city")


@query
def dim_product_scd1(spark, sf):
    return _marts(spark, sf)["dim_product"].drop("product_key")


def _customer_natural(dim: DataFrame, spark, sf) -> DataFrame:
    return _with_geography(dim.drop("customer_key"), spark, sf)


@query
def scd2_new_customers(spark, sf):
    w = warehouse(spark, sf)
    new = scd2_new(w["run1.marts.dim_customer_before"], w["run1.staging.customers"], natural_key="customer_id")
    return new


@query
def scd2_changed_customers(spark, sf):
    w = warehouse(spark, sf)
    snap = dims.customer_snapshot(w["run2.staging.customers"])
    ch = scd2_changes(w["run2.marts.dim_customer_before"], snap, natural_key="customer_id", tracked=dims.TRACKED)
    return _with_geography(ch.select("customer_id", "geography_key", "marketing_optin",
                                     F.col("old_marketing_optin").alias("previous_marketing_optin")), spark, sf)


@query
def dim_customer_scd2(spark, sf):
    return _customer_natural(_marts(spark, sf)["dim_customer"], spark, sf)


@query
def dim_customer_late_snapshots(spark, sf):
    """Three snapshots, the oldest arriving last: customers move in the second one and back in the third."""
    w, store = warehouse(spark, sf), TableStore(spark)
    first, second = w["run1.staging.customers"], w["run2.staging.customers"]
    dim, log = dims.empty(spark, dims.DIM_CUSTOMER_SCHEMA), dims.customer_log(first)
    for customers, run_ts in ((second, fixtures.RUN_TS_2), (first, fixtures.RUN_TS_3), (first, fixtures.RUN_TS_1)):
        dim, log = dims.dim_customer_any_order(dim, log, customers, run_ts)
        dim, log = store.materialize("late.dim_customer", dim), store.materialize("late.customer_log", log)
    return _customer_natural(dim, spark, sf)


@query
def customer_key_map(spark, sf):
    """Dense keys of the customer versions: those of the first load keep theirs when the second load adds its own."""
    w, store, natural = warehouse(spark, sf), TableStore(spark), ["customer_id", "effective_from"]
    keys = spark.createDataFrame([], "customer_id long, effective_from timestamp_ntz, version_no long")
    for versions in (w["run2.marts.dim_customer_before"], _marts(spark, sf)["dim_customer"]):
        keys = store.materialize("keys.customer_versions", assign_keys(keys, versions, natural, out="version_no"))
    return keys


# --- facts -------------------------------------------------------------------------------
@query
def asof_customer_join(spark, sf):
    o = _stg(spark, sf, "orders").select("order_id", "customer_id", "order_ts")
    v = _marts(spark, sf)["dim_customer"].select(F.col("customer_id").alias("v_id"), "effective_from", "effective_to")
    return asof_window_join(o, v, "customer_id", "v_id", "order_ts").select("order_id", "customer_id", "order_ts", "effective_from")


def fact_orders_natural(fo: DataFrame, spark, sf) -> DataFrame:
    prods = _marts(spark, sf)["dim_product"].select("product_key", "product_id")
    return _naturalise(fo, spark, sf).join(prods, "product_key", "left").drop("product_key")


@query
def fact_orders(spark, sf):
    return fact_orders_natural(_marts(spark, sf)["fact_orders"], spark, sf)


_MONTHLY: dict[tuple[str, str], MonthlyTable] = {}
_MONTHLY_LOCK = threading.Lock()


def _monthly_orders(spark, sf) -> MonthlyTable:
    """The order fact by month, brought to the second load from a first one with other versions, orders and lines."""
    key = (spark.sparkContext.applicationId, sf.rstrip("/"))
    with _MONTHLY_LOCK:
        if key not in _MONTHLY:
            w, m = warehouse(spark, sf), _marts(spark, sf)
            after = {"orders": w["staging.orders"], "order_items": w["staging.order_items"], "dim_customer": m["dim_customer"]}
            # the state before: first versions of all customers, some orders of 1997 not yet there, some lines with other quantities
            late = F.year("order_ts").eqNullSafe(1997) & (F.col("order_id") % 50 == 0)
            items = after["order_items"].withColumn("quantity", F.when(F.col("order_id") % 5000 == 1, F.col("quantity") + 1).otherwise(F.col("quantity")))
            before = {"orders": after["orders"].where(~late), "order_items": items, "dim_customer": w["run2.marts.dim_customer_before"]}
            table = MonthlyTable(TableStore(spark), f"monthly-{abs(hash(key))}", "order_date_key")
            table.write(facts.fact_orders(before["orders"], before["order_items"], m["dim_product"], before["dim_customer"]))
            propagate.propagate(table, before, after, m["dim_product"])
            _MONTHLY[key] = table
        return _MONTHLY[key]


@query
def fact_orders_monthly(spark, sf):
    """The monthly fact after late orders, changed lines and changed versions were propagated: equal to a full build."""
    schema = _marts(spark, sf)["fact_orders"].schema
    return fact_orders_natural(_monthly_orders(spark, sf).read(schema).drop("month"), spark, sf)


@query
def daily_revenue_last30(spark, sf):
    """Daily revenue of the fact's last 30 days; the months outside are not opened."""
    m = _marts(spark, sf)
    last = m["fact_orders"].agg(F.max("order_date_key")).first()[0]
    if last is None:
        return timeseries.daily_revenue(m)
    first = (dt.datetime.strptime(str(last), "%Y%m%d") - dt.timedelta(days=29)).strftime("%Y%m%d")
    recent = _monthly_orders(spark, sf).between(m["fact_orders"].schema, int(first), last)
    return timeseries.daily_revenue({**m, "fact_orders": recent.drop("month")})


@query
def fact_sessions(spark, sf):
    return _naturalise(_marts(spark, sf)["fact_sessions"], spark, sf)


# --- data quality ----------------------------------------------------------------------------
def _dq(spark, sf):
    m = _marts(spark, sf)
    return quality.dq_report(m["fact_orders"], m["dim_customer"], m["dim_product"])


@query
def dq_orphans(spark, sf):
    return _dq(spark, sf).where(F.col("check_id").isin(1, 2))


@query
def dq_one_current(spark, sf):
    return _dq(spark, sf).where(F.col("check_id") == 3)


@query
def dq_scd2_overlap(spark, sf):
    return _dq(spark, sf).where(F.col("check_id") == 4)


@query
def dq_revenue_math(spark, sf):
    return _dq(spark, sf).where(F.col("check_id").isin(5, 6))


@query
def dq_report(spark, sf):
    return _dq(spark, sf)


# --- analysis ------------------------------------------------------------------------------------
@query
def first_order_month(spark, sf):
    return _naturalise(cohort.first_order_month(_marts(spark, sf)), spark, sf)


@query
def cohort_sizes(spark, sf):
    return cohort.cohort_sizes(cohort.first_order_month(_marts(spark, sf)))


@query
def cohort_retention(spark, sf):
    return cohort.cohort_retention(_marts(spark, sf))


@query
def cohort_retention_recent(spark, sf):
    # report order (presentation only): cohort, then offset
    return cohort.recent_cohorts(cohort.cohort_retention(_marts(spark, sf))) \
        .orderBy(F.col("cohort_month").asc_nulls_last(), F.col("months_since_signup").asc_nulls_last())


_RFM: dict = {}
_RFM_LOCK = threading.Lock()


def _rfm_scores(spark, sf):
    """Scores are computed once per application (their input is checkpointed)."""
    key = (spark.sparkContext.applicationId, sf)
    with _RFM_LOCK:
        if key not in _RFM:
            _RFM[key] = rfm.rfm_scores(_marts(spark, sf))
        return _RFM[key]


@query
def rfm_scores(spark, sf):
    return _rfm_scores(spark, sf).select("customer_id", "effective_from", "recency_days", "frequency", "monetary",
                                         "r_score", "f_score", "m_score")


@query
def ntile_distributed_lines(spark, sf):
    fo = _marts(spark, sf)["fact_orders"].select("order_id", "line_no", "net_revenue")
    return ntile_distributed(fo, 100, ["net_revenue", "order_id", "line_no"], out="tile")


@query
def rfm_segments(spark, sf):
    return rfm.rfm_segments(_marts(spark, sf), _rfm_scores(spark, sf)).drop("customer_key")


@query
def rfm_segment_summary(spark, sf):
    # report order: largest revenue first (DESC puts NULLs first, as the database does)
    return rfm.segment_summary(rfm.rfm_segments(_marts(spark, sf), _rfm_scores(spark, sf))) \
        .orderBy(F.col("total_revenue").desc_nulls_first())


@query
def funnel_overall(spark, sf):
    return funnel.funnel_overall(_marts(spark, sf)["fact_sessions"])


@query
def funnel_by_source(spark, sf):
    return funnel.funnel_by_source(_marts(spark, sf)["fact_sessions"])


@query
def funnel_top_sources(spark, sf):
    return funnel.top_sources(funnel.funnel_by_source(_marts(spark, sf)["fact_sessions"]))


@query
def product_quarter(spark, sf):
    return product.product_quarter(_marts(spark, sf)).drop("product_key")


@query
def product_performance_q(spark, sf):
    return product.product_performance_q(_marts(spark, sf)).drop("product_key")


@query
def top3_products_latest_q(spark, sf):
    m = _marts(spark, sf)
    # report order: category (NULL category last), then rank
    return product.top_products_latest_quarter(m).drop("product_key") \
        .orderBy(F.col("category").asc_nulls_last(), F.col("rank_in_category").asc_nulls_last())


@query
def daily_revenue(spark, sf):
    return timeseries.daily_revenue(_marts(spark, sf))


@query
def daily_revenue_trend(spark, sf):
    return timeseries.daily_revenue_trend(_marts(spark, sf))


@query
def daily_trend_last30(spark, sf):
    return timeseries.last_days(timeseries.daily_revenue_trend(_marts(spark, sf)))


@query
def daily_revenue_trend_calendar(spark, sf):
    return timeseries.daily_revenue_trend_calendar(_marts(spark, sf))


@query
def customer_ltv(spark, sf):
    return ltv.customer_ltv(_marts(spark, sf))


@query
def customer_ltv_dense(spark, sf):
    return ltv.customer_ltv_dense(_marts(spark, sf))


@query
def cohort_retention_by_customer(spark, sf):
    """Cohorts of natural customers: a customer who moved stays one cohort member."""
    return cohort.cohort_retention(_marts(spark, sf), by="customer")


@query
def ltv_month6(spark, sf):
    return ltv.ltv_at_month(ltv.customer_ltv(_marts(spark, sf))).orderBy(F.col("cohort_month").asc_nulls_last())


# Keys whose natural name is taken by the operator imported above.
REGISTRY["dedup_latest"] = REGISTRY.pop("dedup_latest_items")
REGISTRY["ntile_distributed"] = REGISTRY.pop("ntile_distributed_lines")
