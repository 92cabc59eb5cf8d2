"""Dimensions: calendar, geography, SCD2 customer, SCD1 product."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge import schemas as S
from martforge.functions import columns as C
from martforge.operators.keys import surrogate_key
from martforge.operators.late_snapshots import OBSERVED, splice
from martforge.operators.scd2 import scd2_apply
from martforge.operators.sinks import insert_if_absent, upsert

CALENDAR_TAIL_DAYS = 30

DIM_DATE_SCHEMA = T.StructType([
    T.StructField("date_key", T.IntegerType(), False), T.StructField("full_date", T.DateType(), False),
    T.StructField("day_of_week", T.ShortType(), False), T.StructField("day_name", T.StringType(), False),
    T.StructField("is_weekend", T.BooleanType(), False), T.StructField("day_of_month", T.ShortType(), False),
    T.StructField("month", T.ShortType(), False), T.StructField("month_name", T.StringType(), False),
    T.StructField("quarter", T.ShortType(), False), T.StructField("year", T.ShortType(), False),
    T.StructField("iso_week", T.ShortType(), False), T.StructField("is_holiday_us", T.BooleanType(), False),
])
DIM_GEOGRAPHY_SCHEMA = T.StructType([
    T.StructField("geography_key", T.LongType(), False), T.StructField("country", T.StringType(), False),
    T.StructField("region", T.StringType(), True), T.StructField("city", T.StringType(), True),
])
DIM_CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customer_key", T.LongType(), False), T.StructField("customer_id", T.LongType(), False),
    T.StructField("email", T.StringType(), False), T.StructField("full_name", T.StringType(), True),
    T.StructField("signup_date_key", T.IntegerType(), False), T.StructField("geography_key", T.LongType(), False),
    T.StructField("marketing_optin", T.BooleanType(), False), T.StructField("effective_from", T.TimestampNTZType(), False),
    T.StructField("effective_to", T.TimestampNTZType(), False), T.StructField("is_current", T.BooleanType(), False),
])
DIM_PRODUCT_SCHEMA = T.StructType([
    T.StructField("product_key", T.LongType(), False), T.StructField("product_id", T.LongType(), False),
    T.StructField("sku", T.StringType(), False), T.StructField("name", T.StringType(), False),
    T.StructField("category", T.StringType(), True), T.StructField("subcategory", T.StringType(), True),
    T.StructField("current_unit_price", S.MONEY, False), T.StructField("current_list_price", S.MONEY, False),
    T.StructField("is_active", T.BooleanType(), False),
])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


# --- calendar ---------------------------------------------------------------
def date_bounds(customers: DataFrame, orders: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """One row (lo, hi): earliest signup/order(/session) day to the latest + 30 days.

    A single aggregate over the union of the date columns (partial min/max per
    task, one tiny merge) — never the cartesian product of the source tables.
    Session days are included so every session's date key exists in the calendar.
    """
    days = customers.select(F.to_date("signup_ts").alias("d")).unionByName(orders.select(F.to_date("order_ts").alias("d")))
    if sessions is not None:
        days = days.unionByName(sessions.select(F.to_date("started_ts").alias("d")))
    return days.agg(F.min("d").alias("lo"), F.date_add(F.max("d"), CALENDAR_TAIL_DAYS).alias("hi"))


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day in [lo, hi] with the calendar attributes.

    A stray timestamp makes it longer, not wrong: joins with the calendar carry no
    broadcast hint, its real size decides.
    """
    d = F.col("full_date")
    days = bounds.where(F.col("lo").isNotNull()).select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    dow = (F.weekday(d) + 1)
    return days.select(
        C.date_key(d).alias("date_key"),
        d.alias("full_date"),
        dow.cast("smallint").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        dow.isin(6, 7).alias("is_weekend"),
        F.dayofmonth(d).cast("smallint").alias("day_of_month"),
        F.month(d).cast("smallint").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).cast("smallint").alias("quarter"),
        F.year(d).cast("smallint").alias("year"),
        F.weekofyear(d).cast("smallint").alias("iso_week"),
        F.lit(False).alias("is_holiday_us"),
    )


def dim_date(existing: DataFrame, staging: dict[str, DataFrame]) -> DataFrame:
    """Append the days the staging data needs (insert-if-absent on date_key)."""
    new = calendar(date_bounds(staging["customers"], staging["orders"], staging.get("sessions")))
    return insert_if_absent(existing, new, ["date_key"])


# --- geography ----------------------------------------------------------------
def geography_labels(df: DataFrame) -> list:
    return [F.coalesce(F.col(c), F.lit(S.UNKNOWN_LABEL)).alias(c) for c in ("country", "region", "city")]


def geography_key() -> F.Column:
    """Surrogate of the (labelled) triple; identical wherever it is computed."""
    return surrogate_key(*[F.coalesce(F.col(c), F.lit(S.UNKNOWN_LABEL)) for c in ("country", "region", "city")])


def dim_geography(existing: DataFrame, customers: DataFrame) -> DataFrame:
    new = customers.select(geography_key().alias("geography_key"), *geography_labels(customers)).distinct()
    return insert_if_absent(existing, new, ["country", "region", "city"])


# --- customer (SCD2) ----------------------------------------------------------------
TRACKED = ("geography_key", "marketing_optin")


def customer_snapshot(customers: DataFrame) -> DataFrame:
    """Staged customers in dimension shape (geography resolved to its key)."""
    return customers.select(
        "customer_id", "email", "full_name", C.date_key("signup_ts").alias("signup_date_key"),
        geography_key().alias("geography_key"), "marketing_optin", "signup_ts",
    )


def dim_customer(existing: DataFrame, customers: DataFrame, run_ts) -> DataFrame:
    return scd2_apply(existing, customer_snapshot(customers), run_ts, natural_key="customer_id", tracked=TRACKED,
                      first_from="signup_ts", surrogate="customer_key")


def customer_log(customers: DataFrame) -> DataFrame:
    """The log of customer snapshots, still empty; ``customers`` gives the column types."""
    return customer_snapshot(customers).withColumn(OBSERVED, F.lit(None).cast("timestamp_ntz")).where("false")


def dim_customer_any_order(existing: DataFrame, log: DataFrame, customers: DataFrame, run_ts) -> tuple[DataFrame, DataFrame]:
    """(dimension, log) after a snapshot that may be older than those applied before."""
    return splice(existing, log, customer_snapshot(customers), run_ts, natural_key="customer_id", tracked=TRACKED,
                  first_from="signup_ts", surrogate="customer_key")


# --- product (SCD1) ----------------------------------------------------------------
PRODUCT_UPDATES = ("sku", "name", "category", "subcategory", "current_unit_price", "current_list_price", "is_active")


def dim_product(existing: DataFrame, products: DataFrame) -> DataFrame:
    incoming = products.select("product_id", "sku", "name", "category", "subcategory",
                               F.col("unit_price").alias("current_unit_price"),
                               F.col("list_price").alias("current_list_price"), "is_active")
    return upsert(existing, incoming, ["product_id"], PRODUCT_UPDATES, surrogate="product_key",
                  new_surrogate=surrogate_key(F.col("product_id")))
