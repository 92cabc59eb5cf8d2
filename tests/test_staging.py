"""Staging rules on literal raw rows, and the CSV landing reader."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from martforge import schemas as S
from martforge.plans import quarantine, staging
from martforge.sources import landing
from tests.conftest import rows

L1 = dt.datetime(2024, 1, 1)
L2 = dt.datetime(2024, 1, 2)


def raw(spark, feed, recs):
    cols = S.RAW_COLUMNS[feed]
    schema = ", ".join(f"{c} string" for c in cols) + ", loaded_at timestamp_ntz"
    return spark.createDataFrame(recs, schema)


def customers(spark):
    return raw(spark, "customers", [
        ("1", "Old@X.com", "Ann", "2020-01-01 00:00:00", "US", "", "LA", "t", L1),
        ("1", None, "Ann", "2020-01-01 00:00:00", "US", "", "LA", "f", L2),       # newer but invalid: prefiltered
        (" 2", "b@x.com", " Bo ", "2020-02-01 00:00:00", None, None, None, "YES", L1),
        ("2", "b2@x.com", "Bo", "2020-02-01 00:00:00", None, None, None, "on", L1),  # same typed key as ' 2'
    ])


def test_customers_prefilter_dedup_typed_key(spark):
    c = staging.stage_customers(customers(spark))
    got = {r["customer_id"]: r for r in c.collect()}
    assert set(got) == {1, 2}
    assert got[1]["email"] == "old@x.com" and got[1]["marketing_optin"] is True and got[1]["region"] is None
    # ' 2' and '2' are one key; tie on loaded_at broken by raw text: '2' > ' 2'
    assert got[2]["email"] == "b2@x.com" and got[2]["marketing_optin"] is False   # 'on' is not on the allow-list


def test_orders_domain_and_cascading_semi_joins(spark):
    cust = staging.stage_customers(customers(spark))
    o = raw(spark, "orders", [
        ("10", "1", "2021-01-01 10:00:00", " Fulfilled ", "WEB", "", "", L1),
        ("11", "1", "2021-01-01 10:00:00", "shipped", "web", None, "4.99", L1),     # bad status
        ("12", "1", "2021-01-01 10:00:00", "placed", "POS", None, "4.99", L1),      # bad channel
        ("13", "9", "2021-01-01 10:00:00", "placed", "ios", "X", "$1.00", L1),     # unknown customer
    ])
    orders = staging.stage_orders(o, cust)
    assert rows(orders, "order_id", "status", "channel", "discount_code", "shipping_cost") == [(10, "fulfilled", "web", None, Decimal("0.00"))]
    p = raw(spark, "products", [("5", " sku-5 ", " Mug ", "home-decor & o'neil 3d", "\tdecor", "$1,234.505", "$0", "no", L1),
                                ("6", "sku-6", "Cup", "", None, "1", "1", "0", L1)])
    prods = staging.stage_products(p)
    got = {r["product_id"]: r for r in prods.collect()}
    assert got[5]["sku"] == "SKU-5" and got[5]["name"] == "Mug" and got[5]["category"] == "Home-Decor & O'Neil 3d"
    assert got[5]["subcategory"] == "\tDecor" and got[5]["unit_price"] == Decimal("1234.51") and got[5]["is_active"] is True
    assert got[6]["category"] is None and got[6]["is_active"] is False
    items = staging.stage_order_items(raw(spark, "order_items", [
        ("10", "1", "5", "2", "$3.00", L1), ("10", "2", "7", "1", "1.00", L1),   # missing product
        ("11", "1", "5", "1", "1.00", L1),                                       # dropped order
    ]), orders, prods)
    assert rows(items) == [(10, 1, 5, 2, Decimal("3.00"))]


def test_sessions_existence_filter(spark):
    cust = staging.stage_customers(customers(spark))
    uid = "a0eebc99-9c0b-4ef8-bb6d-6bb9bd3800{:02d}"
    s = raw(spark, "sessions", [
        (uid.format(1), None, "2021-01-01 00:00:00", "2021-01-01 00:00:02.5", "1", "true", "f", "no", "", None, L1),
        (uid.format(2), "", "2021-01-01 00:00:00", "2021-01-01 00:00:00", "1", "false", "false", "false", "google", "c", L1),
        (uid.format(3), "1", "2021-01-01 00:00:00", "2021-01-01 00:00:00", "0", "t", "on", "y", None, None, L1),
        (uid.format(4), "99", "2021-01-01 00:00:00", "2021-01-01 00:00:00", "0", "t", "t", "t", None, None, L1),
    ])
    got = {r["session_id"][-2:]: r for r in staging.stage_sessions(s, cust).collect()}
    assert set(got) == {"01", "02", "03"}
    assert got["02"]["customer_id"] is None and got["03"]["customer_id"] == 1
    assert got["01"]["utm_source"] is None and got["03"]["reached_checkout"] is True


def test_strict_mode_raises_and_quarantine_reports(spark):
    p = raw(spark, "products", [("5", "s", "n", None, None, "abc", "1", "1", L1), ("6", "t", "m", None, None, "", "1", "1", L1)])
    with pytest.raises(PySparkException):
        staging.stage_products(p).collect()
    lenient = staging.stage_products(p, strict=False)
    assert rows(lenient, "product_id", "unit_price") == [(5, None), (6, None)]


def test_reject_summary(spark):
    feeds = {
        "customers": customers(spark),
        "products": raw(spark, "products", [("5", "s", "n", None, None, "1", "1", "1", L1), ("x", "s", "n", None, None, "1", "1", "1", L1)]),
        "orders": raw(spark, "orders", [("10", "1", "2021-01-01 10:00:00", "placed", "web", "", "", L1),
                                        ("11", "1", "2021-01-01 10:00:00", "shipped", "web", "", "", L1),
                                        ("12", "7", "2021-01-01 10:00:00", "placed", "web", "", "", L1)]),
        "order_items": raw(spark, "order_items", [("10", "1", "5", "1", "1", L1), ("10", "1", "5", "1", "1", L1),
                                                  ("11", "1", "5", "1", "1", L1)]),
        "sessions": raw(spark, "sessions", []),
    }
    got = {(r["feed"], r["reason"]): r["n_rows"] for r in quarantine.reject_summary(feeds).collect()}
    assert got == {("customers", "missing_required"): 1, ("customers", "superseded"): 1, ("products", "bad_key"): 1,
                   ("orders", "bad_domain"): 1, ("orders", "orphan"): 1, ("order_items", "superseded"): 1,
                   ("order_items", "orphan"): 1}


CSV = ('order_id,customer_id,order_ts,status,channel,discount_code,shipping_cost\n'
       '1,,2021-01-01 00:00:00,placed,web,"",4.99\n'
       '2,5,2021-01-01 00:00:00,"say ""hi""",web,"multi\nline",\n')


def test_csv_landing_quirks(spark):
    d = tempfile.mkdtemp(prefix="martforge-csv-")
    with open(os.path.join(d, "orders.csv"), "w") as f:
        f.write(CSV)
    df = landing.read_feed(spark, os.path.join(d, "orders.csv"), "orders", "2024-01-01 00:00:00")
    got = {r["order_id"]: r for r in df.collect()}
    assert got["1"]["customer_id"] is None          # ,,  -> NULL
    assert got["1"]["discount_code"] == ""          # ,"", -> empty string
    assert got["2"]["status"] == 'say "hi"'          # doubled quote escapes a quote
    assert got["2"]["discount_code"] == "multi\nline"  # quoted newline stays in the value
    assert got["2"]["shipping_cost"] is None
    assert got["1"]["loaded_at"] == dt.datetime(2024, 1, 1)


def test_csv_landing_rejects_wrong_field_count(spark):
    d = tempfile.mkdtemp(prefix="martforge-csv-")
    path = os.path.join(d, "orders.csv")
    with open(path, "w") as f:
        f.write(CSV.splitlines()[0] + "\n1,2,3,4,5,6,7,EXTRA\n")
    with pytest.raises(Exception):
        landing.read_feed(spark, path, "orders", "2024-01-01 00:00:00").collect()


def test_incremental_load_equals_full_reload(spark):
    from martforge.sources.store import TableStore
    from martforge.streaming.incremental import run_incremental_load
    base = tempfile.mkdtemp(prefix="martforge-inc-")
    store = TableStore(spark, f"{base}/store")
    drops = [
        [("1", "7", "2021-01-01 00:00:00", "placed", "web", "", "1.00"), ("2", "7", "2021-01-02 00:00:00", "placed", "ios", "", "")],
        [("1", "7", "2021-01-01 00:00:00", "refunded", "web", "X", "1.00"), ("3", None, "2021-01-03 00:00:00", "placed", "web", "", "")],
        [("2", "8", "2021-01-02 00:00:00", "cancelled", "ios", "", "2")],
    ]
    cols = ", ".join(f"{c} string" for c in S.RAW_COLUMNS["orders"])
    times = iter([dt.datetime(2024, 1, d) for d in (1, 2, 3)])
    for i, drop in enumerate(drops):
        landing.write_feed_csv(spark.createDataFrame(drop, cols), f"{base}/landing", "orders")
        ticks = next(times)
        out = run_incremental_load(spark, "orders", f"{base}/landing", "orders_latest", f"{base}/ckpt", store, clock=lambda t=ticks: t)
    got = {r["order_id"]: (r["status"], r["customer_id"], r["loaded_at"].day) for r in out.collect()}
    assert got == {"1": ("refunded", "7", 2), "2": ("cancelled", "8", 3), "3": ("placed", None, 2)}
