"""Contracts enforced by writes, all-or-nothing releases, and the routing of raw rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martforge import schemas as S
from martforge.operators import contracts
from martforge.plans import facts, quarantine, staging, warehouse
from martforge.sources import landing
from martforge.sources.store import TableStore
from tests.conftest import rows
from tests.test_staging import customers, raw

L1, L2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
CONTRACT = {"not_null": ("a",), "range": {"a": "> 0"}, "domain": {"b": ("x", "y")}, "row": ("a <= c",), "unique": [("a",)]}


def feeds(spark):
    return {
        "customers": customers(spark),
        "products": raw(spark, "products", [("5", "s", "n", None, None, "1", "1", "1", L1)]),
        "orders": raw(spark, "orders", [("10", "1", "2021-01-01 10:00:00", "placed", "web", "", "", L1)]),
        "order_items": raw(spark, "order_items", [("10", "1", "5", "2", "$1.50", L1)]),
        "sessions": raw(spark, "sessions", [("0" * 8 + "-0000-4000-8000-" + "0" * 12, "", "2021-01-01 10:00:00", "2021-01-01 11:00:00", "3",
                                             "true", "false", "false", "", "", L1)]),
    }


def test_row_rules_are_counted_by_the_write(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", 2), (0, "z", None), (None, None, 1), (5, "y", 4)], "a int, b string, c int").repartition(3)
    store = TableStore(spark, str(tmp_path))
    version, written, found = contracts.write_observed(store, "t", df, "t", CONTRACT)
    assert {v.subject: v.n_bad for v in found} == {"t.a": 1, "t.a > 0": 1, "t.b": 1, "t: a <= c": 1}   # NULL passes a CHECK
    assert written.count() == 4 and store.current_version("t") is None                                    # written, not published
    _, _, none = contracts.write_observed(store, "t", df.where("a > 100"), "t", CONTRACT)
    assert contracts.broken(none) == [] and len(none) == 4


def test_the_write_is_the_only_scan(spark, tmp_path, monkeypatch):
    plans = []
    plain = TableStore.write_version

    def seen(self, name, df, partition_by=None):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return plain(self, name, df, partition_by)
    monkeypatch.setattr(TableStore, "write_version", seen)
    source = f"{tmp_path}/source"
    spark.range(100).selectExpr("cast(id as int) a", "'x' b", "200 c").write.parquet(source)
    monkeypatch.setattr(type(spark.range(1)), "count", lambda self: pytest.fail("a second scan"))
    contracts.write_observed(TableStore(spark, f"{tmp_path}/store"), "t", spark.read.parquet(source), "t", CONTRACT)
    assert len(plans) == 1 and plans[0].count("CollectMetrics") == 1 and plans[0].count("Relation") == 1


def test_a_broken_build_publishes_nothing(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    good = facts.fact_orders
    monkeypatch.setattr(facts, "fact_orders", lambda *a: good(*a).withColumn("quantity", -F.col("quantity")).withColumn("product_key", F.lit(7).cast("long")))
    with pytest.raises(contracts.ContractError) as e:
        warehouse.build_from_feeds(spark, [(feeds(spark), "2024-02-01 00:00:00")], store)
    assert {(v.check, v.subject) for v in e.value.violations} == {
        ("range", "fact_orders.quantity > 0"), ("foreign_key", "fact_orders(product_key) -> dim_product(product_key)")}
    assert store.read_release(warehouse.RELEASE) == {}
    monkeypatch.setattr(facts, "fact_orders", good)
    warehouse.build_from_feeds(spark, [(feeds(spark), "2024-02-01 00:00:00")], store)
    released = store.read_release(warehouse.RELEASE)
    assert {n.rsplit(".", 1)[1] for n in released} == set(S.MART_CONTRACTS)
    assert rows(released["marts.fact_orders"], "order_id", "line_no", "quantity") == [(10, 1, 2)]
    monkeypatch.setattr(facts, "fact_orders", lambda *a: good(*a).withColumn("status", F.lit("lost")))
    with pytest.raises(contracts.ContractError):
        warehouse.build_from_feeds(spark, [(feeds(spark), "2024-02-01 00:00:00")], store)
    assert rows(store.read_release(warehouse.RELEASE)["marts.fact_orders"], "status") == [("placed",)]   # the first one is still live


def test_releases_are_whole_and_numbered(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    one = {"a": store.write_version("a", spark.range(1)), "b": store.write_version("b", spark.range(2))}
    two = {"a": store.write_version("a", spark.range(3)), "b": one["b"]}
    assert store.publish_release("r", one) == 1 and store.publish_release("r", two) == 2
    assert {n: df.count() for n, df in store.read_release("r").items()} == {"a": 3, "b": 2}


def test_every_row_has_one_outcome(spark, tmp_path):
    f = feeds(spark)
    f["orders"] = raw(spark, "orders", [
        ("10", "1", "2021-01-01 10:00:00", "placed", "web", "", "", L1), ("10", "1", "2021-01-01 10:00:00", "placed", "web", "", "", L1),
        (" 10", "1", "soon", "placed", "web", "", "", dt.datetime(2023, 1, 1)), (None, "1", "soon", "lost", "web", "", "", L1), ("x", "1", "soon", "lost", "web", "", "", L1),
        ("11", "nobody", "soon", "lost", "web", "", "", L1), ("12", "7", "soon", "placed", "web", "", "", L1), ("13", "1", "soon", "placed", "web", "", "", L1),
        ("14", "1", None, "placed", "web", "", "", L1), ("15", "1", "2021-01-01 10:00:00", "placed", "web", "", "much", L1), ("16", None, "2021-01-01 10:00:00", "placed", "web", "", "1", L1)])
    s0 = f["sessions"].first()
    s = lambda k, **kw: tuple({**s0.asDict(), "session_id": f"{k:08d}-0000-4000-8000-" + "0" * 12, **kw}.values())
    f["sessions"] = raw(spark, "sessions", [s(1), s(2, customer_id="1"), s(3, customer_id="77"), s(4, customer_id="guest"), s(5, purchased="maybe"),
                                            s(6, ended_ts="2020-01-01 00:00:00"), s(7, pages_viewed=None), s(8, session_id="none"), s(9, customer_id=None)])
    routed = quarantine.route_all(f, TableStore(spark, str(tmp_path)))
    got = sorted((r["reason"], r["record"].split("|")[0]) for r in quarantine.rejects(routed).where("feed = 'orders'").collect())
    assert got == sorted([("superseded", "10"), ("superseded", " 10"), ("missing_required", "\\N"), ("bad_key", "x"), ("bad_domain", "11"), ("orphan", "12"),
                          ("bad_value", "13"), ("bad_value", "14"), ("bad_value", "15"), ("orphan", "16")])
    got = {(r["record"].split("|")[0].lstrip("0")[:1], r["reason"]) for r in quarantine.rejects(routed).where("feed = 'sessions'").collect()}
    assert got == {("3", "orphan"), ("4", "bad_value"), ("5", "bad_value"), ("6", "bad_value"), ("7", "bad_value"), ("n", "bad_key")}
    assert rows(quarantine.accepted_rows(routed, "orders"), "order_id") == [(10,)]
    assert quarantine.accepted_rows(routed, "sessions").count() == 3
    for r in quarantine.accounting(routed).collect():
        assert r["raw_rows"] == f[r["feed"]].count() == r["accepted_rows"] + r["superseded_rows"] + r["rejected_rows"]


def test_routing_clean_feeds_equals_staging(spark, tmp_path):
    f = feeds(spark)
    routed = quarantine.route_all(f, TableStore(spark, str(tmp_path)))
    staged = staging.stage_all(f)
    for feed in S.FEEDS:
        assert rows(quarantine.accepted_rows(routed, feed)) == rows(staged[feed]), feed


def test_records_that_do_not_parse_are_kept(spark, tmp_path):
    f = feeds(spark)
    for feed in S.FEEDS:
        landing.write_feed_csv(f[feed], f"{tmp_path}/in/{feed}.csv", feed)
    with open(f"{tmp_path}/in/orders.csv/late.csv", "w") as out:
        out.write(",".join(S.RAW_COLUMNS["orders"]) + "\n11,1,2021-01-01 10:00:00,placed\n12,1,2021-01-01 10:00:00,placed,web,,,more,fields\n")
    landed = landing.land(spark, f"{tmp_path}/in", "2024-01-01 00:00:00", lenient=True)
    routed = quarantine.route_all(landed, TableStore(spark, f"{tmp_path}/store"))
    bad = [(r["feed"], r["record"]) for r in quarantine.rejects(routed).where("reason = 'unparsed'").collect()]
    assert sorted(bad) == [("orders", "11,1,2021-01-01 10:00:00,placed"), ("orders", "12,1,2021-01-01 10:00:00,placed,web,,,more,fields")]
    assert rows(quarantine.accepted_rows(routed, "orders"), "order_id") == [(10,)]


def planted(spark):
    """Feeds where keys repeat with equal and other contents, references are blank or lost, and keys do not parse."""
    f = feeds(spark)
    day = lambda i: L1 + dt.timedelta(days=i)
    f["orders"] = raw(spark, "orders", [(o, c, "2021-01-01 10:00:00", s, "web", "", "", day(i % 3)) for i, (o, c, s) in enumerate(
        (o, c, s) for o in ("10", " 10", "11", "12", "x", None) for c in ("1", "7", None) for s in ("placed", "lost"))])
    f["order_items"] = raw(spark, "order_items", [(o, n, p, q, "1.50", day(i % 2)) for i, (o, n, p, q) in enumerate(
        (o, n, p, q) for o in ("10", "11", "99", "x", None) for n in ("1", " 1", "2", "first") for p in ("5", "6", "none", None) for q in ("1", "0", "1"))])
    s0 = f["sessions"].first().asDict()
    f["sessions"] = raw(spark, "sessions", [tuple({**s0, "session_id": k, "customer_id": c, "pages_viewed": str(n)}.values()) for k in (
        "0" * 8 + "-0000-4000-8000-" + "0" * 12, "1" * 8 + "-0000-4000-8000-" + "1" * 12, "none", None) for c in ("", "1", "77", "guest", None) for n in (1, 1, 2)])
    return f


def test_hot_keys_take_another_path_to_the_same_outcome(spark, tmp_path, monkeypatch):
    f, found = planted(spark), {}
    for limit in (1_000_000, 40, 0):    # no hot key, some, all
        monkeypatch.setattr(quarantine, "HOT_ROWS", limit)
        routed = quarantine.route_all(f, TableStore(spark, f"{tmp_path}/{limit}"))
        found[limit] = {feed: rows(df) for feed, df in routed.items()}
    assert found[1_000_000] == found[40] == found[0]
    for feed, got in found[0].items():
        assert len(got) == f[feed].count()
    assert {r[-2] for r in found[0]["order_items"]} == {"missing_required", "bad_key", "superseded", "orphan"}


def test_rows_are_stored_once_and_travel_as_raw_text(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quarantine, "HOT_ROWS", 1_000_000, raising=False)
    seen, plain = {}, TableStore.write_version

    def write(self, name, df, partition_by=None):
        seen[name.rsplit(".", 1)[-1]] = df
        return plain(self, name, df, partition_by)
    monkeypatch.setattr(TableStore, "write_version", write)
    quarantine.route_all(planted(spark), TableStore(spark, str(tmp_path)))
    assert set(seen) == set(S.FEEDS)     # no table of flagged rows beside the routed ones
    assert "record" not in seen["order_items"].columns
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = seen["order_items"].select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    # lines meet the products, then the other lines and the order of their key; each parent comes to them once
    assert plan.count("Exchange hashpartitioning") == 4


def test_queries_on_raw_feeds_need_no_build(spark, monkeypatch):
    from martforge.plans import registry
    data = "/root/testdata/sf0.001"
    monkeypatch.setattr(warehouse, "_BUILT", {})
    monkeypatch.setattr(warehouse, "_saved", lambda *a: None, raising=False)
    monkeypatch.setattr(warehouse, "build_from_feeds", lambda *a, **k: pytest.fail("built"))
    monkeypatch.setattr(registry, "warehouse", lambda *a: pytest.fail("built"))
    assert registry.REGISTRY["stg_reject_summary"](spark, data).count() == 1


def test_tasks_are_bounded_whatever_the_number_of_partitions(spark):
    from martforge.session import BOUNDED_TASKS_CONF, apply_bounded_tasks_conf
    for k, v in BOUNDED_TASKS_CONF.items():
        spark.conf.unset(k)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7m")
    try:
        apply_bounded_tasks_conf(spark)
        got = {k: spark.conf.get(k) for k in BOUNDED_TASKS_CONF}
        assert got == {**BOUNDED_TASKS_CONF, "spark.sql.files.maxPartitionBytes": "7m"}     # the session's own setting stays
    finally:
        for k in BOUNDED_TASKS_CONF:
            spark.conf.unset(k)


def test_a_stored_table_can_be_read_in_small_parts(spark, tmp_path):
    import glob
    import pyarrow.parquet as pq
    store = TableStore(spark, str(tmp_path))
    version = store.write_version("t", spark.range(0, 5_000_000, 1, 1).selectExpr("hash(id) a", "xxhash64(id) b", "xxhash64(id + 1) c"))
    found = [pq.ParquetFile(f).metadata for f in glob.glob(f"{tmp_path}/t/v={version}/*.parquet")]
    assert sum(m.num_row_groups for m in found) > 4    # about 100 MB
