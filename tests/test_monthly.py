"""Facts by month: pruning, single-month rewrites, and propagation equal to a full build."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martforge.plans import facts, propagate
from martforge.sources.monthly import MonthlyTable
from martforge.sources.store import TableStore
from tests.conftest import rows

T = dt.datetime
ORDERS = "order_id long, customer_id long, order_ts timestamp_ntz, status string, channel string, discount_code string, shipping_cost decimal(10,2)"
ITEMS = "order_id long, line_no int, product_id long, quantity int, unit_price decimal(10,2)"


def state(spark, r, n=40):
    """Random orders, lines and customer versions over 2021."""
    def ts():
        return T(2021, 1, 1) + dt.timedelta(hours=r.randrange(24 * 364))
    versions = []
    for c in range(4):
        cuts = [T(2020, 1, 1), *sorted({ts() for _ in range(r.randrange(3))}), T(9999, 12, 31)]
        versions += [(100 * c + k, c, a, b) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    orders = [(i, r.randrange(4), ts(), "placed", "web", None, None) for i in range(n)]
    items = [(i, k, 1, r.randrange(1, 4), None) for i in range(n) for k in range(r.randrange(1, 3))]
    return orders, items, versions


def frames(spark, s):
    dim = spark.createDataFrame(s[2], "customer_key long, customer_id long, effective_from timestamp_ntz, effective_to timestamp_ntz")
    items = spark.createDataFrame(s[1], ITEMS).withColumn("unit_price", F.lit("2.50").cast("decimal(10,2)"))
    orders = spark.createDataFrame(s[0], ORDERS).withColumn("shipping_cost", F.lit(0).cast("decimal(10,2)"))
    return {"orders": orders, "order_items": items, "dim_customer": dim}


def changed(r, s):
    """Late, dropped and moved orders, other quantities, one customer with other versions."""
    orders, items, versions = s
    orders = [o for o in orders if o[0] % 13] + [(1000, 2, T(2021, 3, 5), "placed", "web", None, None)]
    items = [(i, k, p, q + (i == 5), u) for i, k, p, q, u in items] + [(1000, 1, 1, 1, None)]
    who = r.randrange(4)
    cut = T(2021, 9, 1)
    kept = [v for v in versions if v[1] != who or v[2] < cut]
    versions = [(k, c, a, min(b, cut)) if c == who else (k, c, a, b) for k, c, a, b in kept] + [(100 * who + 50, who, cut, T(9999, 12, 31))]
    return orders, items, versions


@pytest.mark.parametrize("seed", range(3))
def test_propagation_equals_a_full_build(spark, tmp_path, seed):
    r = random.Random(seed)
    product = spark.createDataFrame([(1, 11)], "product_id long, product_key long")
    first = state(spark, r)
    before, after = frames(spark, first), frames(spark, changed(r, first))
    table = MonthlyTable(TableStore(spark, str(tmp_path)), "f", "order_date_key")
    full = facts.fact_orders(before["orders"], before["order_items"], product, before["dim_customer"])
    table.write(full)
    live = table.months()
    months = propagate.propagate(table, before, after, product)
    expected = facts.fact_orders(after["orders"], after["order_items"], product, after["dim_customer"])
    assert rows(table.read(full.schema).drop("month")) == rows(expected)
    untouched = set(live) - set(months)
    assert untouched and all(table.months()[m] == live[m] for m in untouched)     # their files keep their names
    assert propagate.propagate(table, after, after, product) == []


def test_a_date_range_opens_its_months_only(spark, tmp_path):
    days = spark.sql("SELECT id AS order_id, cast(date_format(date_add(DATE'2021-01-01', cast(id % 365 as int)), 'yyyyMMdd') as int) AS order_date_key FROM range(2000)")
    table = MonthlyTable(TableStore(spark, str(tmp_path)), "f", "order_date_key")
    table.write(days)
    got = table.between(days.schema, 20210320, 20210418)
    opened = {f.split("month=")[1].split("/")[0] for f in spark.createDataFrame([], "x int").sparkSession.read.parquet(f"{tmp_path}/f").inputFiles()}
    assert len(opened) == 12
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    read = {p.split("month=")[1].split("/")[0] for (p,) in got.select(F.input_file_name()).distinct().collect()}
    assert read == {"202103", "202104"}
    assert rows(got.select("order_id")) == rows(days.where("order_date_key BETWEEN 20210320 AND 20210418").select("order_id"))


def test_one_month_is_rewritten_or_emptied(spark, tmp_path):
    df = spark.createDataFrame([(1, 20210105), (2, 20210206), (3, 20210207)], "id long, d int")
    table = MonthlyTable(TableStore(spark, str(tmp_path)), "f", "d")
    assert rows(table.read(df.schema)) == []
    table.write(df)
    before = table.months()
    table.write(spark.createDataFrame([(9, 20210228), (8, 20210101)], "id long, d int"), [202102])    # January is not asked for
    assert rows(table.read(df.schema), "id") == [(1,), (9,)] and table.months()[202101] == before[202101]
    table.write(df.where("false"), [202102])
    assert rows(table.read(df.schema), "id", "month") == [(1, 202101)]
