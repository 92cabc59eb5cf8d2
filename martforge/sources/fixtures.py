"""The driver's Parquet tables re-expressed as the warehouse's five raw text feeds.

The raw layer is all text plus a load timestamp, exactly what a CSV landing
produces; these feeds are derived from the driver tables (so they grow with
them) and deliberately carry the messiness the staging layer must absorb:
``$1,234.50`` prices, mixed-case statuses, spelled booleans, blank codes,
blank anonymous customers, fractional-second timestamps, duplicate
(order, line) pairs.  A second customer snapshot drives SCD2 changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge import schemas as S

# Fixed values of the fixture mapping.
RUN_TS_1 = "2001-01-15 00:00:00"       # load time of the first run
RUN_TS_2 = "2001-02-01 00:00:00"       # second run: customer snapshot with movers
RUN_TS_3 = "2001-03-01 00:00:00"       # a third snapshot, equal to the first; in the late-snapshot query only
SIGNUP_EPOCH = "1995-01-01"            # signup = epoch + (custkey % 365) days
SESSION_SHIFT_DAYS = 10532             # moves the event stream into March 1995
OPTIN_TRUE_SPELLINGS = ["True", "1", " yes ", "t"]      # by custkey % 4
OPTIN_FALSE_SPELLINGS = ["False", "0", "no", "f"]
UTM_SOURCES = ["search_a", "search_b", "social_a", "social_b", "direct", "mail", "partner", ""]  # by k % 8
UTM_CAMPAIGNS = ["", "campaign_a", "campaign_b", "campaign_c"]                                       # by k % 4
SHIPPING = ["", "4.99", "7.99", "9.99"]                                                        # by orderkey % 4
INPUT_TABLES = ("region", "nation", "customer", "part", "orders", "lineitem", "events")       # driver tables read


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts_text(c: Column, fraction: bool = False) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS" if fraction else "yyyy-MM-dd HH:mm:ss")


def money_text(amount: Column) -> Column:
    """Double amount with two decimals -> ``$12,345.67`` (built from integer cents)."""
    cents = F.round(amount * 100).cast("long")
    return F.concat(F.lit("$"), F.format_number(F.floor(cents / 100), 0),
                    F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def _loaded(ts: str) -> Column:
    return F.lit(ts).cast("timestamp_ntz").alias("loaded_at")


def raw_customers(spark: SparkSession, sf_dir: str, snapshot: int = 1) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    moved = (F.col("c_custkey") % 10 == 0) if snapshot == 2 else F.lit(False)
    flipped = (F.col("c_custkey") % 15 == 0) if snapshot == 2 else F.lit(False)
    nation_key = F.when(moved, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey"))
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    optin = (F.col("c_acctbal") > 0) != flipped
    idx = (F.col("c_custkey") % 4).cast("int") + 1
    base = c.withColumn("nk", nation_key).join(F.broadcast(geo), F.col("nk") == geo.n_nationkey)
    return base.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.concat(F.col("c_name"), F.lit("@Example.com")).alias("email"),
        F.col("c_name").alias("full_name"),
        _ts_text(F.date_add(F.lit(SIGNUP_EPOCH).cast("date"), (F.col("c_custkey") % 365).cast("int")).cast("timestamp_ntz")).alias("signup_ts"),
        F.col("r_name").alias("country"),
        F.col("n_name").alias("region"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("")).otherwise(F.col("c_mktsegment")).alias("city"),
        F.when(optin, F.element_at(F.array(*map(F.lit, OPTIN_TRUE_SPELLINGS)), idx))
        .otherwise(F.element_at(F.array(*map(F.lit, OPTIN_FALSE_SPELLINGS)), idx)).alias("marketing_optin"),
        _loaded(RUN_TS_1 if snapshot == 1 else RUN_TS_2),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    price = money_text(F.col("p_retailprice"))
    return p.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.concat(F.lit("sku-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        price.alias("unit_price"),
        price.alias("list_price"),
        F.when(F.col("p_size") > 2, F.lit("Yes")).otherwise(F.lit("0")).alias("is_active"),
        _loaded(RUN_TS_1),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    even = k % 2 == 0
    status = (
        F.when(F.col("o_orderstatus") == "F", F.when(even, F.lit("fulfilled")).otherwise(F.lit(" Fulfilled ")))
        .when(F.col("o_orderstatus") == "O", F.when(even, F.lit("placed")).otherwise(F.lit("PLACED")))
        .when(F.col("o_orderpriority") == "1-URGENT", F.lit("refunded"))
        .otherwise(F.lit("cancelled"))
    )
    return o.select(
        k.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        _ts_text(F.col("o_orderdate")).alias("order_ts"),
        status.alias("status"),
        F.element_at(F.array(F.lit("web"), F.lit("ios"), F.lit("android")), (k % 3).cast("int") + 1).alias("channel"),
        F.when(F.col("o_orderpriority") == "2-HIGH", F.lit("WELCOME10")).otherwise(F.lit("")).alias("discount_code"),
        F.element_at(F.array(*map(F.lit, SHIPPING)), (k % 4).cast("int") + 1).alias("shipping_cost"),
        _loaded(RUN_TS_1),
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("line_no"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity"),
        money_text(F.col("l_extendedprice")).alias("unit_price"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("loaded_at"),
    )


def raw_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session per (user, day) of the event stream."""
    e = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    per = e.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.min("ts").alias("t0"), F.max("ts").alias("t1"), F.count(F.lit(1)).alias("pages"),
        F.bool_or(F.col("event_type") == "click").alias("cart"),
        F.bool_or(F.col("event_type") == "signup").alias("signup"),
        F.bool_or(F.col("event_type") == "purchase").alias("purchase"),
        F.min_by(k, F.struct("ts", "event_id")).alias("k"),
    )
    shift = F.lit(-SESSION_SHIFT_DAYS)
    cart = F.col("cart")
    checkout = cart & F.col("signup")
    bought = checkout & F.col("purchase")
    flag = lambda c: F.when(c, F.lit("true")).otherwise(F.lit("false"))
    return per.select(
        F.concat(F.lpad(F.col("user_id").cast("string"), 8, "0"), F.lit("-0000-4000-8000-"),
                 F.lpad(F.date_format("day", "yyyyMMdd"), 12, "0")).alias("session_id"),
        F.when(F.col("user_id") % 3 == 0, F.lit("")).otherwise(F.col("user_id").cast("string")).alias("customer_id"),
        _ts_text(F.timestamp_add("DAY", shift, F.col("t0")), fraction=True).alias("started_ts"),
        _ts_text(F.timestamp_add("DAY", shift, F.col("t1")), fraction=True).alias("ended_ts"),
        F.col("pages").cast("string").alias("pages_viewed"),
        flag(cart).alias("added_to_cart"),
        flag(checkout).alias("reached_checkout"),
        flag(bought).alias("purchased"),
        F.element_at(F.array(*map(F.lit, UTM_SOURCES)), (F.col("k") % 8) + 1).alias("utm_source"),
        F.element_at(F.array(*map(F.lit, UTM_CAMPAIGNS)), (F.col("k") % 4) + 1).alias("utm_campaign"),
        _loaded(RUN_TS_1),
    )


def raw_feeds(spark: SparkSession, sf_dir: str, snapshot: int = 1) -> dict[str, DataFrame]:
    """The five raw feeds of one load (snapshot 2 differs only in customers)."""
    feeds = {
        "customers": raw_customers(spark, sf_dir, snapshot),
        "products": raw_products(spark, sf_dir),
        "orders": raw_orders(spark, sf_dir),
        "order_items": raw_order_items(spark, sf_dir),
        "sessions": raw_sessions(spark, sf_dir),
    }
    for name, df in feeds.items():
        assert tuple(df.columns) == S.RAW_COLUMNS[name] + ("loaded_at",), name
    return feeds


def planted_feeds(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The raw feeds with rows planted that staging must set aside, for every reason a feed can have."""
    def number(column: str) -> Column:
        return F.col(column).cast("bigint")

    def planted(df: DataFrame, n: Column, rules: list[tuple[int, str, Column | None]], again: int) -> DataFrame:
        """Every ``again``-th row has an older copy; then rule by rule the column of every d-th row is replaced."""
        df = df.withColumn("__n", n)
        copies = F.when(F.col("__n") % again == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        df = df.withColumn("__old", F.explode(copies)).withColumn("loaded_at", F.expr("loaded_at - make_dt_interval(__old)"))
        for divisor, column, value in rules:
            df = df.withColumn(column, F.when(F.col("__n") % divisor == 0, value).otherwise(F.col(column)))
        return df.drop("__n", "__old")

    def text(value: str) -> Column:
        return F.lit(value)

    gone = F.lit(None).cast("string")
    return {
        "customers": planted(raw["customers"], number("customer_id"), [
            (43, "signup_ts", text("never")), (31, "email", gone), (37, "customer_id", F.concat(F.lit("c"), "customer_id"))], 41),
        "products": planted(raw["products"], number("product_id"), [
            (47, "unit_price", text("free")), (43, "list_price", text("-1")), (53, "product_id", F.concat(F.lit("p"), "product_id")),
            (59, "product_id", gone)], 61),
        "orders": planted(raw["orders"], number("order_id"), [
            (103, "status", text("lost")), (101, "channel", gone), (107, "customer_id", text("999999999")), (109, "order_ts", text("soon")),
            (89, "shipping_cost", text("much")), (83, "customer_id", gone), (113, "order_id", F.concat(F.lit("o"), "order_id")), (131, "order_id", gone)], 127),
        "order_items": planted(raw["order_items"], number("order_id") * 8 + number("line_no"), [
            (97, "quantity", text("many")), (101, "quantity", text("0")), (103, "unit_price", gone), (107, "product_id", text("none")),
            (109, "line_no", text("first")), (113, "line_no", gone)], 127),
        "sessions": planted(raw["sessions"], F.substring("session_id", 1, 8).cast("bigint"), [
            (41, "added_to_cart", text("maybe")), (43, "customer_id", text("guest")), (47, "customer_id", text("999999999")),
            (53, "ended_ts", text("1995-01-01 00:00:00")), (59, "session_id", text("none")), (61, "session_id", gone)], 67),
    }


def planted_marts(marts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The marts with bad rows planted by rules over their natural keys: every rule of the contract is broken somewhere."""
    def every(n: int, key: str) -> Column:
        return F.col(key) % n == 0

    def blank(df: DataFrame, column: str, where: Column) -> DataFrame:
        return df.withColumn(column, F.when(~where, F.col(column)))

    def replaced(df: DataFrame, column: str, value, where: Column) -> DataFrame:
        kind = df.schema[column].dataType
        return df.withColumn(column, F.when(where, (value if isinstance(value, Column) else F.lit(value)).cast(kind)).otherwise(F.col(column)))

    def twice(df: DataFrame, where: Column) -> DataFrame:
        return df.withColumn("__copy", F.explode(F.when(where, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("__copy")

    out = dict(marts)
    out["dim_date"] = twice(blank(marts["dim_date"], "day_name", F.col("day_of_month") == 13), F.col("day_of_month") == 31)
    out["dim_geography"] = twice(blank(marts["dim_geography"], "country", F.col("city") == S.UNKNOWN_LABEL), F.col("city") == "BUILDING")
    c = replaced(marts["dim_customer"], "effective_to", F.expr("effective_from - INTERVAL 1 DAY"), every(47, "customer_id"))
    c = blank(blank(c, "email", every(53, "customer_id")), "signup_date_key", every(59, "customer_id"))
    c = replaced(replaced(c, "geography_key", -1, every(61, "customer_id")), "signup_date_key", 19000101, every(67, "customer_id"))
    out["dim_customer"] = twice(c, every(43, "customer_id"))
    p = blank(replaced(marts["dim_product"], "sku", "SKU-1", every(41, "product_id")), "name", every(37, "product_id"))
    out["dim_product"] = twice(replaced(p, "current_unit_price", -F.col("current_unit_price"), every(29, "product_id")), every(31, "product_id"))
    f = replaced(marts["fact_orders"], "order_date_key", F.col("order_date_key") + 50000000, every(83, "order_id"))
    f = replaced(f, "customer_key", -1, every(67, "order_id"))
    f = blank(replaced(f, "product_key", -1, every(61, "order_id")), "product_key", every(89, "order_id"))
    f = replaced(replaced(f, "quantity", -F.col("quantity"), every(79, "order_id")), "unit_price", -F.col("unit_price"), every(59, "order_id"))
    f = blank(replaced(replaced(f, "status", "lost", every(73, "order_id")), "channel", "fax", every(53, "order_id")), "channel", every(47, "order_id"))
    out["fact_orders"] = twice(replaced(f, "net_revenue", F.col("net_revenue") + 1, every(71, "order_id")), every(97, "order_id"))
    g = replaced(marts["fact_sessions"], "customer_key", -1, F.col("customer_key").isNotNull() & every(5, "duration_seconds"))
    g = replaced(g, "ended_ts", F.expr("started_ts - INTERVAL 1 DAY"), every(7, "duration_seconds"))
    g = blank(replaced(g, "session_date_key", 19000101, every(11, "duration_seconds")), "session_date_key", every(13, "duration_seconds"))
    out["fact_sessions"] = twice(replaced(g, "pages_viewed", -1, every(17, "duration_seconds")), every(19, "duration_seconds"))
    return out
