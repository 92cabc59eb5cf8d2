"""Snapshots of the customer dimension that arrive in any order."""

import datetime as dt
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martforge.operators import quality
from martforge.plans import dims
from tests.conftest import rows

SIGNUP = dt.datetime(2020, 1, 1)
SNAP = ("customer_id long, email string, full_name string, signup_ts timestamp_ntz, country string, region string, "
        "city string, marketing_optin boolean")


def _cut(spark, df):
    return spark.createDataFrame(df.collect(), df.schema)


def _any_order(spark, snaps):
    dim, log = dims.empty(spark, dims.DIM_CUSTOMER_SCHEMA), dims.customer_log(snaps[0][0])
    for snap, run_ts in snaps:
        dim, log = (_cut(spark, x) for x in dims.dim_customer_any_order(dim, log, snap, run_ts))
    return dim, log


def _in_order(spark, snaps):
    dim = dims.empty(spark, dims.DIM_CUSTOMER_SCHEMA)
    for snap, run_ts in sorted(snaps, key=lambda s: s[1]):
        dim = _cut(spark, dims.dim_customer(dim, snap, run_ts))
    return dim


def _one(spark, city, email="a@x"):
    return spark.createDataFrame([(1, email, "A", SIGNUP, "US", None, city, True)], SNAP)


def test_old_values_resume_where_a_snapshot_confirmed_them(spark):
    snaps = [(_one(spark, "A"), "2021-01-01 00:00:00"), (_one(spark, "A", "new@x"), "2023-01-01 00:00:00"),
             (_one(spark, "A"), "2024-01-01 00:00:00"), (_one(spark, "B"), "2022-01-01 00:00:00")]
    dim, log = _any_order(spark, snaps)
    got = [tuple(r) for r in dim.orderBy("effective_from").select("effective_from", "effective_to", "email", "is_current").collect()]
    assert got == [
        (SIGNUP, dt.datetime(2022, 1, 1), "a@x", False),
        (dt.datetime(2022, 1, 1), dt.datetime(2023, 1, 1), "a@x", False),
        (dt.datetime(2023, 1, 1), dt.datetime(9999, 12, 31), "new@x", True),
    ]
    assert log.count() == 4


def test_a_snapshot_that_comes_twice_changes_nothing(spark):
    snaps = [(_one(spark, "B"), "2022-01-01 00:00:00"), (_one(spark, "A"), "2021-01-01 00:00:00")]
    dim, log = _any_order(spark, snaps)
    again, log2 = dims.dim_customer_any_order(dim, log, _one(spark, "C"), "2021-01-01 00:00:00")
    assert rows(again) == rows(dim) and rows(log2) == rows(log)
    empty, log3 = dims.dim_customer_any_order(dim, log, _one(spark, "C").where("false"), "2020-06-01 00:00:00")
    assert rows(empty) == rows(dim) and rows(log3) == rows(log)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000))
def test_every_order_of_arrival_gives_the_same_dimension(spark, seed):
    rnd = random.Random(seed)
    snaps = []
    for year in range(2021, 2025):
        recs = [(c, f"{c}-{rnd.randint(0, 2)}@x", "N", SIGNUP, rnd.choice(["US", None]), None, rnd.choice(["A", "B"]), rnd.choice([True, True, False]))
                for c in range(10) if rnd.random() < 0.8]
        snaps.append((spark.createDataFrame(recs, SNAP), f"{year}-01-01 00:00:00"))
    want = _in_order(spark, snaps)
    rnd.shuffle(snaps)
    dim, _ = _any_order(spark, snaps)
    assert rows(dim) == rows(want)
    assert quality.one_current_violations(dim).count() == 0
    assert quality.overlapping_pairs(dim).first()["n_bad"] == 0
