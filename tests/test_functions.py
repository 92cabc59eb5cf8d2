import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martforge.functions import columns as C


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("out")).first()["out"]


@pytest.mark.parametrize("text,expected", [
    ("home-decor & o'neil 3d", "Home-Decor & O'Neil 3d"),
    ("ECONOMY", "Economy"),
    ("Brand#17", "Brand#17"),
    ("small ring", "Small Ring"),
    ("\thome", "\tHome"),
    ("élan vital", "Élan Vital"),
    (None, None),
])
def test_initcap_words(spark, text, expected):
    assert one(spark, C.initcap_words("v"), text) == expected


def test_initcap_after_blank_to_null(spark):
    assert one(spark, C.initcap_words(C.blank_to_null("v")), "   ") is None
    # trim strips spaces only, a tab survives (same in both SQL dialects)
    assert one(spark, C.initcap_words(C.blank_to_null("v")), "\tdecor ") == "\tDecor"


@pytest.mark.parametrize("text,expected", [
    ("$1,234.50", Decimal("1234.50")),
    ("$1,234.505", Decimal("1234.51")),
    ("-0.005", Decimal("-0.01")),
    ("12", Decimal("12.00")),
    (" 7.5 ", Decimal("7.50")),
])
def test_parse_money(spark, text, expected):
    assert one(spark, C.parse_money("v"), text) == expected


@pytest.mark.parametrize("bad", ["abc", ""])
def test_parse_money_strict_raises_and_lenient_nulls(spark, bad):
    with pytest.raises(PySparkException):
        one(spark, C.parse_money("v"), bad)
    assert one(spark, C.parse_money("v", strict=False), bad) is None


@pytest.mark.parametrize("text,allow,deny", [
    ("true", True, True), ("T", True, True), (" yes ", True, True), ("1", True, True),
    ("false", False, False), ("0", False, False), ("no", False, True), ("f", False, True),
    ("YES", True, True), ("on", False, True), (None, False, True),
])
def test_boolean_normalisers(spark, text, allow, deny):
    assert one(spark, C.bool_allow_list("v"), text) is allow
    assert one(spark, C.bool_deny_list("v"), text) is deny


@pytest.mark.parametrize("text,expected", [
    ("true", True), ("TRU", True), ("on", True), ("Y", True), ("1", True),
    ("off", False), ("fals", False), ("n", False), ("0", False), (None, None),
])
def test_strict_boolean(spark, text, expected):
    assert one(spark, C.bool_strict("v"), text) is expected


def test_strict_boolean_rejects(spark):
    with pytest.raises(PySparkException):
        one(spark, C.bool_strict("v"), "maybe")
    assert one(spark, C.bool_strict("v", strict=False), "o") is None  # ambiguous prefix of on/off


def test_uuid_text(spark):
    u = "A0EEBC99-9C0B-4EF8-BB6D-6BB9BD380A11"
    assert one(spark, C.uuid_text("v"), f" {u} ") == u.lower()
    with pytest.raises(PySparkException):
        one(spark, C.uuid_text("v"), "not-a-uuid")


@pytest.mark.parametrize("seconds,expected", [(2.5, 3), (2.4999, 2), (0.5, 1), (0.0, 0), (59.5, 60)])
def test_duration_rounds_half_up(spark, seconds, expected):
    start = dt.datetime(2024, 1, 1, 0, 0, 0)
    end = start + dt.timedelta(seconds=seconds)
    df = spark.createDataFrame([(start, end)], "s timestamp_ntz, e timestamp_ntz")
    assert df.select(C.duration_seconds("s", "e").alias("d")).first()["d"] == expected


def test_pct_and_growth(spark):
    df = spark.createDataFrame([(1, 3, Decimal("10.00"), Decimal("0.00"))], "a long, b long, x decimal(12,2), z decimal(12,2)")
    r = df.select(C.pct("a", "b").alias("p"), C.pct("a", F.lit(0)).alias("p0"),
                  C.growth_pct("x", "z").alias("g0"), C.pct(F.lit(1), F.lit(8)).alias("p8")).first()
    assert r["p"] == Decimal("33.33")
    assert r["p0"] is None
    assert r["g0"] is None
    assert r["p8"] == Decimal("12.50")


def test_pct_half_away_from_zero(spark):
    # 100 * 1 / 8 = 12.5 -> scale 0 rounds to 13; 100 * 1 / 400 = 0.25 -> scale 1 rounds to 0.3
    df = spark.createDataFrame([(1,)], "a long")
    r = df.select(C.pct("a", F.lit(8), 0).alias("p"), C.pct("a", F.lit(400), 1).alias("q")).first()
    assert r["p"] == Decimal("13") and r["q"] == Decimal("0.3")


def test_avg_round(spark):
    df = spark.createDataFrame([(Decimal("10.01"), 2)], "s decimal(22,2), n long")
    assert df.select(C.avg_round("s", "n", 2).alias("a")).first()["a"] == Decimal("5.01")  # 5.005 -> 5.01


def test_date_key_and_month_diff(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 12, 30, 23, 59), dt.date(2024, 3, 1), dt.date(2023, 11, 1))],
                               "ts timestamp_ntz, a date, b date")
    r = df.select(C.date_key("ts").alias("k"), C.month_diff("a", "b").alias("m"), C.month_start("ts").alias("ms")).first()
    assert r["k"] == 20241230 and r["m"] == 4 and r["ms"] == dt.date(2024, 12, 1)


def test_averages_and_shares_round_once_at_any_size(spark):
    """A wide sum's quotient keeps 6 decimals in Spark; rounding that again would give 5.01."""
    df = spark.sql("SELECT CAST('100105.00' AS DECIMAL(38,2)) AS total, 20001L AS n, CAST('-100105.00' AS DECIMAL(38,2)) AS debt, 0L AS none")
    r = df.select(C.avg_round("total", "n", 2).alias("a"), C.avg_round("debt", "n", 2).alias("b"), C.avg_round("total", "none", 2).alias("c"),
                  C.pct("n", F.lit(200010)).alias("d"), C.pct(F.lit(1), F.lit(8), 0).alias("e")).first()
    from decimal import Decimal as D
    assert (r["a"], r["b"], r["c"], r["d"], r["e"]) == (D("5.00"), D("-5.00"), None, D("10.00"), D("13"))
    import random
    rnd = random.Random(1)
    pairs = [(D(rnd.randint(-10**12, 10**12)) / 100, rnd.randint(1, 10**6)) for _ in range(300)]
    got = spark.createDataFrame(pairs, "t decimal(38,2), n long").select("t", "n", C.avg_round("t", "n", 2).alias("a")).collect()
    from decimal import ROUND_HALF_UP
    assert all(x["a"] == (x["t"] / x["n"]).quantize(D("0.01"), ROUND_HALF_UP) for x in got)
