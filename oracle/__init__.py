"""DuckDB oracle: one SQL string per registered query key (see ``oracle.sql``)."""

from __future__ import annotations

from martforge import schemas as S
from oracle import quarantine
from oracle.marts import contract_report
from oracle.sql import cents, dbl, dkey, initcap, money_text, parse_money, pct_int, pct_money, q, ratio, _latest, ITEM_COLS

STG_TABLE = {"customers": "stg_customers_2", "products": "stg_products", "orders": "stg_orders",
             "order_items": "stg_order_items", "sessions": "stg_sessions"}


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _chk_unique() -> str:
    parts = []
    for t, c in S.STAGING_CONTRACTS.items():
        for keys in c["unique"]:
            k = ", ".join(keys)
            nulls = " OR ".join(f"{x} IS NULL" for x in keys)
            parts.append(f"SELECT 'unique' AS \"check\", '{t}({k})' AS subject, CAST(COALESCE(sum(n) FILTER (WHERE n > 1 OR has_null), 0) AS BIGINT) AS n_bad "
                         f"FROM (SELECT count(*) AS n, bool_or({nulls}) AS has_null FROM {STG_TABLE[t]} GROUP BY {k})")
    return _union(parts)


def _chk_not_null() -> str:
    return _union([f"SELECT 'not_null' AS \"check\", '{t}.{col}' AS subject, count(*) FILTER (WHERE {col} IS NULL) AS n_bad FROM {STG_TABLE[t]}"
                   for t, c in S.STAGING_CONTRACTS.items() for col in c["not_null"]])


def _chk_fk() -> str:
    parts = []
    for t, c in S.STAGING_CONTRACTS.items():
        for ck, p, pk in c.get("foreign_keys", []):
            cond = " AND ".join(f"x.{a} = y.{b}" for a, b in zip(ck, pk))
            present = " AND ".join(f"x.{a} IS NOT NULL" for a in ck)
            parts.append(f"SELECT 'foreign_key' AS \"check\", '{t}({', '.join(ck)}) -> {p}({', '.join(pk)})' AS subject, count(*) AS n_bad "
                         f"FROM {STG_TABLE[t]} x WHERE {present} AND NOT EXISTS (SELECT 1 FROM {STG_TABLE[p]} y WHERE {cond})")
    return _union(parts)


def _chk_range() -> str:
    return _union([f"SELECT 'range' AS \"check\", '{t}.{col} {b}' AS subject, count(*) FILTER (WHERE NOT ({col} {b})) AS n_bad FROM {STG_TABLE[t]}"
                   for t, c in S.STAGING_CONTRACTS.items() for col, b in c.get("range", {}).items()])


def _chk_domain() -> str:
    parts = []
    for t, c in S.STAGING_CONTRACTS.items():
        for col, allowed in c.get("domain", {}).items():
            vals = ", ".join(f"'{v}'" for v in allowed)
            parts.append(f"SELECT 'domain' AS \"check\", '{t}.{col}' AS subject, count(*) FILTER (WHERE NOT ({col} IN ({vals}))) AS n_bad FROM {STG_TABLE[t]}")
    return _union(parts)


def _chk_row() -> str:
    return _union([f"SELECT 'row' AS \"check\", '{t}: {rule}' AS subject, count(*) FILTER (WHERE NOT ({rule})) AS n_bad FROM {STG_TABLE[t]}"
                   for t, c in S.STAGING_CONTRACTS.items() for rule in c.get("row", ())])


_DQ = """SELECT * , n_bad = 0 AS passed FROM (
SELECT 1 AS check_id, 'order lines whose customer version is missing' AS "check", count(*) AS n_bad FROM fact_orders f
  WHERE NOT EXISTS (SELECT 1 FROM dim_customer d WHERE d.customer_id = f.customer_id AND d.effective_from = f.customer_effective_from)
UNION ALL
SELECT 2, 'order lines whose product is missing', count(*) FROM fact_orders f WHERE NOT EXISTS (SELECT 1 FROM stg_products p WHERE p.product_id = f.product_id)
UNION ALL
SELECT 3, 'customers with no or several current versions', count(*) FROM (
  SELECT customer_id FROM dim_customer GROUP BY customer_id HAVING count(*) FILTER (WHERE is_current) <> 1)
UNION ALL
SELECT 4, 'pairs of versions valid at the same time', count(*) FROM dim_customer a JOIN dim_customer b
  ON a.customer_id = b.customer_id AND a.effective_from <> b.effective_from
 AND a.effective_from < b.effective_to AND b.effective_from < a.effective_to
UNION ALL
SELECT 7, 'versions that end before they begin', count(*) FROM dim_customer WHERE effective_to < effective_from
UNION ALL
SELECT 5, 'order lines whose net differs from gross less discount', count(*) FILTER (WHERE round(net_revenue, 2) <> round(gross_revenue - discount_amount, 2)) FROM fact_orders
UNION ALL
SELECT 6, 'order lines with a quantity or price out of range', count(*) FILTER (WHERE quantity <= 0 OR unit_price < 0) FROM fact_orders)"""

_FACT_ORDERS = (f"SELECT order_id, line_no, order_date_key, customer_id, customer_effective_from, product_id, quantity, {dbl('unit_price')} AS unit_price, "
                f"{dbl('gross_revenue')} AS gross_revenue, {dbl('discount_amount')} AS discount_amount, {dbl('net_revenue')} AS net_revenue, "
                f"{dbl('shipping_cost')} AS shipping_cost, status, channel, discount_code FROM fact_orders")

_PPQ = (f"SELECT product_id, product_name, category, subcategory, year, quarter, {dbl('net_revenue')} AS net_revenue, units_sold, unique_buyers, "
        f"rank_in_category, pct_of_category, percentile_in_category, {dbl('prev_quarter_revenue')} AS prev_quarter_revenue, qoq_growth_pct "
        f"FROM product_performance_q")

_TREND_COLS = (f"full_date, {dbl('net_revenue')} AS net_revenue, orders, unique_customers, rev_7d_avg, rev_28d_avg, "
               f"{dbl('rev_same_dow_lw')} AS rev_same_dow_lw, {dbl('rev_same_day_ly')} AS rev_same_day_ly, wow_growth_pct, yoy_growth_pct")


def _trend_from(source: str) -> str:
    base = (f"SELECT *, sum(net_revenue) OVER w7 AS s7, count(*) OVER w7 AS n7, sum(net_revenue) OVER w28 AS s28, count(*) OVER w28 AS n28, "
            f"lag(net_revenue, 7) OVER w AS rev_same_dow_lw, lag(net_revenue, 365) OVER w AS rev_same_day_ly FROM {source} "
            f"WINDOW w AS (ORDER BY full_date), w7 AS (ORDER BY full_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), "
            f"w28 AS (ORDER BY full_date ROWS BETWEEN 27 PRECEDING AND CURRENT ROW)")
    return (f"SELECT full_date, net_revenue, orders, unique_customers, {ratio(cents('s7'), '100 * n7', 2)} AS rev_7d_avg, "
            f"{ratio(cents('s28'), '100 * n28', 2)} AS rev_28d_avg, rev_same_dow_lw, rev_same_day_ly, "
            f"{ratio('100 * (' + cents('net_revenue') + ' - ' + cents('rev_same_dow_lw') + ')', cents('rev_same_dow_lw'), 2)} AS wow_growth_pct, "
            f"{ratio('100 * (' + cents('net_revenue') + ' - ' + cents('rev_same_day_ly') + ')', cents('rev_same_day_ly'), 2)} AS yoy_growth_pct "
            f"FROM ({base})")


_DENSE_DAILY = ("(SELECT d.full_date, COALESCE(r.net_revenue, CAST(0 AS DECIMAL(18,2))) AS net_revenue, COALESCE(r.orders, 0) AS orders, "
                "COALESCE(r.unique_customers, 0) AS unique_customers FROM dim_date d LEFT JOIN daily_revenue r ON r.full_date = d.full_date "
                "WHERE d.full_date BETWEEN (SELECT min(full_date) FROM daily_revenue) AND (SELECT max(full_date) FROM daily_revenue))")

ORACLE: dict[str, str] = {
    "raw_load_summary": q(_union([f"SELECT '{t}' AS table_name, count(*) AS row_count FROM raw_{t if t != 'customers' else 'customers_1'}"
                                  for t in S.FEEDS])),
    "src_csv_landing": q("SELECT order_id, customer_id, order_ts, status, channel, discount_code, shipping_cost, loaded_at FROM raw_orders"),
    "sink_full_refresh_idempotent": q(_FACT_ORDERS),
    "streaming_daily_funnel": q(f"SELECT day, visited, carted, checked_out, purchased, {pct_int('carted', 'visited')} AS pct_browse_to_cart, "
                                f"{pct_int('purchased', 'visited')} AS pct_visit_to_purchase FROM (SELECT day, count(*) AS visited, "
                                f"count(*) FILTER (WHERE cart) AS carted, count(*) FILTER (WHERE cart AND su) AS checked_out, "
                                f"count(*) FILTER (WHERE cart AND su AND pu) AS purchased FROM ev_sessions GROUP BY day)"),
    "sink_insert_if_absent": q("SELECT country, region, city FROM dim_geography"),
    "dedup_latest": q("SELECT CAST(order_id AS BIGINT) AS order_id, CAST(line_no AS INTEGER) AS line_no, product_id, quantity, unit_price, loaded_at "
                      f"FROM {_latest('raw_order_items', 'CAST(order_id AS BIGINT), CAST(line_no AS INTEGER)', ITEM_COLS)}"),
    "stg_customers": q("SELECT * FROM stg_customers_2"),
    "stg_products": q(f"SELECT product_id, sku, name, category, subcategory, {dbl('unit_price')} AS unit_price, {dbl('list_price')} AS list_price, is_active FROM stg_products"),
    "stg_orders": q(f"SELECT order_id, customer_id, order_ts, status, channel, discount_code, {dbl('shipping_cost')} AS shipping_cost FROM stg_orders"),
    "incremental_orders_load": q(f"SELECT order_id, customer_id, order_ts, status, channel, discount_code, {dbl('shipping_cost')} AS shipping_cost FROM stg_orders"),
    "stg_order_items": q(f"SELECT order_id, line_no, product_id, quantity, {dbl('unit_price')} AS unit_price FROM stg_order_items"),
    "stg_sessions": q("SELECT * FROM stg_sessions"),
    "fn_initcap_words": q(f"SELECT p_partkey AS product_id, {initcap('p_type')} AS category, {initcap('p_brand')} AS subcategory, "
                          f"{initcap('p_name')} AS name_title FROM part"),
    "fn_parse_money": q(f"SELECT l_orderkey AS order_id, l_linenumber AS line_no, {money_text('l_extendedprice')} AS price_text, "
                        f"{dbl(parse_money(money_text('l_extendedprice')))} AS price FROM lineitem"),
    "chk_unique": q(_chk_unique()),
    "chk_not_null": q(_chk_not_null()),
    "chk_foreign_key": q(_chk_fk()),
    "chk_range": q(_chk_range()),
    "chk_domain": q(_chk_domain()),
    "chk_row": q(_chk_row()),
    "dim_date_bounds": q("SELECT CAST(lo AS DATE) AS lo, CAST(hi AS DATE) AS hi FROM date_bounds"),
    "dim_date": q("SELECT * FROM dim_date"),
    "dim_geography": q("SELECT * FROM dim_geography_1"),
    "dim_product_scd1": q(f"SELECT product_id, sku, name, category, subcategory, {dbl('unit_price')} AS current_unit_price, "
                          f"{dbl('list_price')} AS current_list_price, is_active FROM stg_products"),
    "scd2_new_customers": q("SELECT * FROM stg_customers_1"),
    "scd2_changed_customers": q("SELECT customer_id, marketing_optin, previous_marketing_optin, country, region, city FROM scd2_changed"),
    "dim_customer_scd2": q(f"SELECT customer_id, email, full_name, {dkey('signup_ts')} AS signup_date_key, marketing_optin, effective_from, "
                           f"effective_to, is_current, country, region, city FROM dim_customer"),
    "dim_customer_late_snapshots": q(f"SELECT customer_id, email, full_name, {dkey('signup_ts')} AS signup_date_key, marketing_optin, effective_from, "
                                     f"effective_to, is_current, country, region, city FROM dim_customer_late"),
    "customer_key_map": q("SELECT customer_id, effective_from, row_number() OVER (ORDER BY load_no, customer_id, effective_from) AS version_no FROM ("
                          "SELECT customer_id, effective_from, CASE WHEN (customer_id, effective_from) IN (SELECT (customer_id, effective_from) FROM cust_v1) "
                          "THEN 1 ELSE 2 END AS load_no FROM dim_customer)"),
    "asof_customer_join": q("SELECT o.order_id, o.customer_id, o.order_ts, dc.effective_from FROM stg_orders o JOIN dim_customer dc "
                            "ON dc.customer_id = o.customer_id AND o.order_ts >= dc.effective_from AND o.order_ts < dc.effective_to"),
    "fact_orders": q(_FACT_ORDERS),
    "fact_sessions": q("SELECT * FROM fact_sessions"),
    "dq_orphans": q(f"SELECT * FROM ({_DQ}) WHERE check_id IN (1, 2)"),
    "dq_one_current": q(f"SELECT * FROM ({_DQ}) WHERE check_id = 3"),
    "dq_scd2_overlap": q(f"SELECT * FROM ({_DQ}) WHERE check_id = 4"),
    "dq_revenue_math": q(f"SELECT * FROM ({_DQ}) WHERE check_id IN (5, 6)"),
    "dq_report": q(_DQ),
    "first_order_month": q("SELECT customer_id, customer_effective_from, cohort_month FROM first_order"),
    "cohort_sizes": q("SELECT cohort_month, n_customers FROM cohort_size"),
    "cohort_retention": q("SELECT * FROM cohort_retention"),
    "cohort_retention_recent": q("SELECT * FROM cohort_retention WHERE cohort_month >= (SELECT max(cohort_month) FROM cohort_retention) - INTERVAL 6 MONTH"),
    "rfm_scores": q(f"SELECT customer_id, effective_from, recency_days, frequency, {dbl('monetary')} AS monetary, r_score, f_score, m_score FROM rfm_scored"),
    "ntile_distributed": q(f"SELECT order_id, line_no, {dbl('net_revenue')} AS net_revenue, "
                           f"CAST(ntile(100) OVER (ORDER BY net_revenue, order_id, line_no) AS INTEGER) AS tile FROM fact_orders"),
    "rfm_segments": q(f"SELECT customer_id, effective_from, email, recency_days, frequency, {dbl('monetary')} AS monetary, r_score, f_score, "
                      f"m_score, rfm_cell, segment FROM rfm_seg"),
    "rfm_segment_summary": q(f"SELECT segment, count(*) AS customers, {ratio('sum(recency_days)', 'count(*)', 1)} AS avg_recency_days, "
                             f"{ratio('sum(frequency)', 'count(*)', 2)} AS avg_frequency, {ratio(cents('sum(monetary)'), '100 * count(*)', 2)} AS avg_monetary, "
                             f"{dbl('CAST(sum(monetary) AS DECIMAL(18,2))')} AS total_revenue, "
                             f"{pct_money('sum(monetary)', 'sum(sum(monetary)) OVER ()')} AS pct_of_revenue FROM rfm_seg GROUP BY segment"),
    "funnel_overall": q(f"SELECT visited, carted, checked_out, purchased, {pct_int('carted', 'visited')} AS pct_browse_to_cart, "
                        f"{pct_int('checked_out', 'carted')} AS pct_cart_to_checkout, {pct_int('purchased', 'checked_out')} AS pct_checkout_to_purchase, "
                        f"{pct_int('purchased', 'visited')} AS pct_visit_to_purchase FROM (SELECT count(*) AS visited, "
                        f"count(*) FILTER (WHERE added_to_cart) AS carted, count(*) FILTER (WHERE reached_checkout) AS checked_out, "
                        f"count(*) FILTER (WHERE purchased) AS purchased FROM fact_sessions)"),
    "funnel_by_source": q("SELECT * FROM funnel_by_source"),
    "funnel_top_sources": q("SELECT * FROM funnel_by_source ORDER BY visited DESC, utm_source LIMIT 10"),
    "product_quarter": q(f"SELECT product_id, product_name, category, subcategory, year, quarter, {dbl('net_revenue')} AS net_revenue, "
                         f"units_sold, unique_buyers FROM product_quarter"),
    "product_performance_q": q(_PPQ),
    "top3_products_latest_q": q(f"SELECT * FROM ({_PPQ}) WHERE CAST(year AS INTEGER) * 10 + quarter = "
                                f"(SELECT max(CAST(year AS INTEGER) * 10 + quarter) FROM product_performance_q) AND rank_in_category <= 3"),
    "daily_revenue": q(f"SELECT full_date, {dbl('net_revenue')} AS net_revenue, orders, unique_customers FROM daily_revenue"),
    "fact_orders_monthly": q(_FACT_ORDERS),
    "daily_revenue_last30": q(f"SELECT full_date, {dbl('net_revenue')} AS net_revenue, orders, unique_customers FROM daily_revenue "
                              "WHERE full_date > (SELECT max(d.full_date) FROM fact_orders f JOIN dim_date d ON d.date_key = f.order_date_key) - INTERVAL 30 DAY"),
    "daily_revenue_trend": q(f"SELECT {_TREND_COLS} FROM daily_revenue_trend"),
    "daily_trend_last30": q(f"SELECT {_TREND_COLS} FROM daily_revenue_trend ORDER BY full_date DESC LIMIT 30"),
    "daily_revenue_trend_calendar": q(f"SELECT {_TREND_COLS} FROM ({_trend_from(_DENSE_DAILY)})"),
    "customer_ltv": q("SELECT * FROM customer_ltv"),
    "customer_ltv_dense": q("SELECT * FROM ltv_dense"),
    "cohort_retention_by_customer": q("SELECT * FROM cohort_retention_by_customer"),
    "ltv_month6": q("SELECT cohort_month, cohort_size, avg_cumulative_revenue_per_cohort_member AS ltv_month_6 FROM customer_ltv WHERE months_since_signup = 6"),
}

# keys that need CTEs of their own after the common ones
for _key, _rest in {"stg_reject_rows": quarantine.REJECT_ROWS, "stg_reject_summary": quarantine.REJECT_SUMMARY,
                    "stg_reject_accounting": quarantine.ACCOUNTING, "src_csv_landing_all": quarantine.LANDED, "stg_accepted_order_items": quarantine.ACCEPTED_ITEMS,
                    "chk_marts_contract": contract_report(planted=False), "chk_marts_planted": contract_report(planted=True)}.items():
    ORACLE[_key] = q("").rstrip() + ",\n" + _rest
