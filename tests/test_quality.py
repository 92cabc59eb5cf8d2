"""Every constraint and data-quality check must be seen failing on a planted bad row."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

from martforge.operators import checks, quality
from martforge.operators.checks import enforce

T = dt.datetime


def n_bad(report):
    return {r["subject"]: r["n_bad"] for r in report.collect()}


def test_unique_and_not_null(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c")], "k long, v string")
    assert n_bad(checks.unique(df, ["k"], "t")) == {"t(k)": 3}          # two duplicates + one NULL key
    assert n_bad(checks.not_null(df, ["k", "v"], "t")) == {"t.k": 1, "t.v": 1}


def test_foreign_key_range_domain_row(spark):
    parent = spark.createDataFrame([(1,)], "id long")
    child = spark.createDataFrame([(1, 5, "web", 1, 2), (2, 0, "POS", 3, 2), (None, -1, None, None, 1)],
                                  "pid long, qty int, channel string, a int, b int")
    assert n_bad(checks.foreign_key(child, ["pid"], parent, ["id"], "c", "p")) == {"c(pid) -> p(id)": 1}  # NULL ref passes
    assert n_bad(checks.ranges(child, {"qty": "> 0"}, "c")) == {"c.qty > 0": 2}
    assert n_bad(checks.domain(child, "channel", ["web", "ios"], "c")) == {"c.channel": 1}             # NULL passes
    assert n_bad(checks.row_rule(child, "a <= b", "c")) == {"c: a <= b": 1}                           # NULL passes
    with pytest.raises(ValueError):
        enforce(checks.domain(child, "channel", ["web", "ios"], "c"))


def _dim(spark, recs):
    return spark.createDataFrame(recs, "customer_key long, customer_id long, effective_from timestamp_ntz, "
                                       "effective_to timestamp_ntz, is_current boolean")


def test_dq_checks_fire(spark):
    end = T(9999, 12, 31)
    dim_c = _dim(spark, [
        (10, 1, T(2020, 1, 1), end, True),
        (11, 1, T(2021, 1, 1), end, True),          # second current row AND overlapping window
        (12, 2, T(2020, 1, 1), T(2021, 1, 1), False),  # no current row
    ])
    dim_p = spark.createDataFrame([(100,)], "product_key long")
    fact = spark.createDataFrame([
        (10, 100, 2, Decimal("1.00"), Decimal("2.00"), Decimal("0.00"), Decimal("2.00")),
        (99, 100, 1, Decimal("1.00"), Decimal("1.00"), Decimal("0.10"), Decimal("1.00")),   # orphan customer, bad net
        (10, 999, 0, Decimal("-1.00"), Decimal("0.00"), Decimal("0.00"), Decimal("0.00")),  # orphan product, qty 0, price < 0
        (None, 100, 1, Decimal("1.00"), Decimal("1.00"), Decimal("0.00"), Decimal("1.00")),  # NULL key is an orphan
    ], "customer_key long, product_key long, quantity int, unit_price decimal(10,2), gross_revenue decimal(12,2), "
       "discount_amount decimal(12,2), net_revenue decimal(12,2)")
    rep = {r["check_id"]: r["n_bad"] for r in quality.dq_report(fact, dim_c, dim_p).collect()}
    assert rep == {1: 2, 2: 1, 3: 2, 4: 2, 5: 1, 6: 1, 7: 0}
    with pytest.raises(ValueError, match="DQ FAIL"):
        quality.dq_enforce(quality.dq_report(fact, dim_c, dim_p))


def _brute_pairs(recs):
    n = 0
    for a in recs:
        for b in recs:
            if a[1] == b[1] and a[0] != b[0] and a[2] < b[3] and b[2] < a[3]:
                n += 1
    return n


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), n=st.integers(1, 40))
def test_overlap_sweep_equals_pairwise(spark, seed, n):
    rnd = random.Random(seed)
    recs = []
    for i in range(n):
        a = rnd.randint(0, 12)
        b = a + rnd.choice([0, 0, 1, 2, 5, -1, -4])     # includes zero-length and inverted windows
        recs.append((i, rnd.randint(1, 3), T(2020, 1, 1) + dt.timedelta(days=a), T(2020, 1, 1) + dt.timedelta(days=b), True))
    got = quality.overlapping_pairs(_dim(spark, recs)).first()["n_bad"]
    assert got == _brute_pairs(recs)
    assert quality.inverted_windows(_dim(spark, recs)).first()["n_bad"] == sum(r[3] < r[2] for r in recs)
