"""Raw rows routed once: accepted into staging, or set aside with the reason and the raw record.

Raw columns alone travel: one exchange by the first part of the key puts a key's rows side
by side, a row number over the order of ``dedup_latest`` finds the newest, and a parent
with the same key is joined in place; other parents are joined before.  Types and records
are made again after the exchange.  One expression then gives each row its reason, and one
job writes accepted and rejected rows, partitioned by the verdict.

A value of that first part with more than ``HOT_ROWS`` rows would load one task.  Such rows
are a table with a row number: the newest row of a key is an aggregate (partial per task,
so a hot key is one row per task) and is joined back by row number, which is unique on both
sides.

Reasons, the first that applies, in the order in which staging would drop the row:

=================  ==================================================================
unparsed           a CSV record that does not fit the feed's columns
missing_required   a required column or a part of the key is NULL
bad_key            the key does not have its type
superseded         a newer row has the same typed key
bad_domain         status or channel outside its list
orphan             the parent row is not accepted (a blank customer of a session is none)
bad_value          a value does not have its type, is missing where staging needs one,
                   or breaks a range or row rule of the staging contract
=================  ==================================================================

Every raw row has exactly one outcome, so raw = accepted + rejected for each feed, and
what is accepted passes the strict casts of staging and its row rules.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge import schemas as S
from martforge.plans import staging
from martforge.sources.store import TableStore

REASONS = ("unparsed", "missing_required", "bad_key", "superseded", "bad_domain", "orphan", "bad_value")
UNPARSED = "unparsed_record"    # optional raw column: the text of a record that did not parse
HOT_ROWS = 1_000_000            # rows that may share the first part of a key in one task


@dataclass(frozen=True)
class Route:
    """How a feed is classified: columns required before dedup, references (column, parent feed), optional values."""
    required: tuple[str, ...] = ()
    parents: tuple[tuple[str, str], ...] = ()
    anonymous: bool = False                     # a blank reference needs no parent
    optional: dict = field(default_factory=dict)  # raw column -> target type of a value that may be blank

    def parent_of(self, column: str) -> str:
        return dict(self.parents)[column]


ROUTES = {
    "customers": Route(required=("customer_id", "email")),
    "products": Route(required=("product_id",)),
    "orders": Route(required=("order_id",), parents=(("customer_id", "customers"),), optional={"shipping_cost": S.MONEY}),
    "order_items": Route(parents=(("order_id", "orders"), ("product_id", "products"))),
    "sessions": Route(parents=(("customer_id", "customers"),), anonymous=True),
}


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _typed(feed: str) -> dict[str, Column]:
    return {f"__t_{name}": c for name, c in staging.typed_columns(feed, strict=False).items()}


def _kept(raw: DataFrame, feed: str) -> list[str]:
    return [*S.RAW_COLUMNS[feed], "loaded_at", *([UNPARSED] if UNPARSED in raw.columns else [])]


def _record(rows: DataFrame, feed: str) -> Column:
    record = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("\\N")) for c in S.RAW_COLUMNS[feed]])
    return F.coalesce(F.col(UNPARSED), record) if UNPARSED in rows.columns else record


def _flagged(raw: DataFrame, feed: str) -> DataFrame:
    """Raw rows with the typed parts of their key and the reason that needs no other row."""
    route, keys = ROUTES[feed], S.FEED_KEYS[feed]
    missing = _any([F.col(c).isNull() for c in (*route.required, *keys)])
    bad_key = _any([F.col(f"__t_{k}").isNull() for k in keys])
    unparsed = F.col(UNPARSED).isNotNull() if UNPARSED in raw.columns else F.lit(False)
    alone = (F.when(unparsed, "unparsed").when(missing, "missing_required").when(bad_key, "bad_key"))
    typed = _typed(feed)
    return raw.select(*_kept(raw, feed), *[typed[f"__t_{k}"].alias(f"__t_{k}") for k in keys]).withColumn("__alone", alone)


def _with_parent(rows: DataFrame, feed: str, column: str, parent: DataFrame, flag: str) -> DataFrame:
    """``rows`` with ``flag``: true if ``parent`` has the row that ``column`` names, else NULL."""
    key, name = S.FEED_KEYS[ROUTES[feed].parent_of(column)][0], f"__t_{column}"
    there = parent.select(F.col(key).alias(name), F.lit(True).alias(flag))
    if column in S.FEED_KEYS[feed]:
        return rows.join(there, name, "left")
    rows = rows.withColumn(name, _typed(feed)[name])
    # rows that name no parent stay out of the join: their NULL keys would all meet in one task
    known = rows.where(F.col(name).isNotNull()).join(there, name, "left")
    nobody = rows.where(F.col(name).isNull()).withColumn(flag, F.lit(None).cast("boolean"))
    return known.unionByName(nobody).drop(name)


def _won_in_place(rows: DataFrame, feed: str) -> DataFrame:
    """``rows``, side by side by the first part of their key, with ``__won``: whether one is the newest of its key."""
    keys = [f"__t_{k}" for k in S.FEED_KEYS[feed]]
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in ("loaded_at", *S.RAW_COLUMNS[feed])])
    return rows.repartition(keys[0]).withColumn("__won", F.row_number().over(newest) == 1)


def _won_by_row(rows: DataFrame, feed: str, store: TableStore, name: str) -> DataFrame:
    """The same without a task that holds all rows of a key."""
    keys = [f"__t_{k}" for k in S.FEED_KEYS[feed]]
    rows = store.materialize(f"{name}.hot", rows.withColumn("__row", F.monotonically_increasing_id()))
    newest = F.max(F.struct("loaded_at", *S.RAW_COLUMNS[feed], "__row")).alias("w")
    winners = rows.groupBy(*keys).agg(newest).select(F.col("w.__row").alias("__row"), F.lit(True).alias("__won"))
    return rows.join(winners, "__row", "left").withColumn("__won", F.col("__won").isNotNull()).drop("__row")


def _bad_value(feed: str) -> Column:
    """A value without its type, a missing one that staging needs, or one that breaks a row rule of the contract."""
    contract = S.STAGING_CONTRACTS[feed]
    bad = [F.col(f"__t_{c}").isNull() for c in contract["not_null"]]
    bad += [(F.nullif(F.col(c), F.lit("")).isNotNull() & F.nullif(F.col(c), F.lit("")).try_cast(kind).isNull()) for c, kind in ROUTES[feed].optional.items()]
    bad += [~F.expr(f"__t_{c} {bound}") for c, bound in contract.get("range", {}).items()]
    if feed == "sessions":
        bad.append(F.col("__t_ended_ts") < F.col("__t_started_ts"))
    return F.coalesce(_any(bad), F.lit(False))


def route(raw: DataFrame, feed: str, accepted: dict[str, DataFrame], store: TableStore, name: str) -> DataFrame:
    """The feed's rows with ``reason`` (NULL if accepted), ``record`` and ``accepted`` (1 or 0), as a table partitioned by the latter."""
    plan, place = ROUTES[feed], S.FEED_KEYS[feed][0]
    flagged = _flagged(raw, feed)
    keyed = flagged.where("__alone IS NULL").drop("__alone")
    found = keyed.groupBy(f"__t_{place}").count().where(F.col("count") > HOT_ROWS).collect()    # one row per HOT_ROWS rows at most
    is_hot = F.col(f"__t_{place}").isin([r[0] for r in found])
    flags = {column: f"__p{i}" for i, (column, _) in enumerate(plan.parents)}

    def with_parents(rows: DataFrame, columns: list[str]) -> DataFrame:
        for c in columns:
            rows = _with_parent(rows, feed, c, accepted[plan.parent_of(c)], flags[c])
        return rows

    before, beside = [c for c in flags if c != place], [c for c in flags if c == place]
    rows = with_parents(_won_in_place(with_parents(keyed.where(~is_hot) if found else keyed, before), feed), beside)
    if found:
        rows = rows.unionByName(with_parents(_won_by_row(keyed.where(is_hot), feed, store, name), [*flags]))
    reason = F.when(~F.col("__won"), "superseded")
    if "domain" in S.STAGING_CONTRACTS[feed]:
        reason = F.coalesce(reason, F.when(~F.coalesce(staging.in_domain(), F.lit(False)), "bad_domain"))
    orphan = F.when(_any([F.col(f).isNull() for f in flags.values()]), "orphan")
    if plan.anonymous:
        column = plan.parents[0][0]
        unnamed = F.col(f"__t_{column}").isNull()
        orphan = F.when(unnamed & F.nullif(F.col(column), F.lit("")).isNotNull(), "bad_value").when(~unnamed, orphan)
    reason = F.coalesce(reason, orphan, F.when(_bad_value(feed), "bad_value"))
    kept = _kept(raw, feed)
    settled = rows.withColumns(_typed(feed)).select(*kept, reason.alias("reason"))
    alone = flagged.where("__alone IS NOT NULL").select(*kept, F.col("__alone").alias("reason"))
    out = settled.unionByName(alone).withColumn("accepted", F.col("reason").isNull().cast("int"))
    stored = store.materialize(name, out, partition_by=["accepted"])
    return stored.select(*S.RAW_COLUMNS[feed], "loaded_at", _record(stored, feed).alias("record"), "reason", "accepted")


def route_all(raw: dict[str, DataFrame], store: TableStore | None = None) -> dict[str, DataFrame]:
    """All feeds, parents first."""
    store = store or TableStore(raw["customers"].sparkSession)
    base, routed, staged = f"routed-{uuid.uuid4().hex[:12]}", {}, {}
    for feed in S.FEEDS:
        routed[feed] = route(raw[feed], feed, staged, store, f"{base}.{feed}")
        staged[feed] = accepted_rows(routed, feed)
    return routed


def accepted_rows(routed: dict[str, DataFrame], feed: str) -> DataFrame:
    """The staged (typed) table of a routed feed; the strict casts cannot fail on it."""
    rows = routed[feed].where("accepted = 1")
    return rows.select(*[c.alias(n) for n, c in staging.typed_columns(feed).items()])


def rejects(routed: dict[str, DataFrame]) -> DataFrame:
    """``(feed, reason, record, loaded_at)`` of every row that was set aside."""
    parts = [df.where("accepted = 0").select(F.lit(feed).alias("feed"), "reason", "record", "loaded_at") for feed, df in routed.items()]
    return reduce(DataFrame.unionByName, parts)


def reject_summary(raw: dict[str, DataFrame]) -> DataFrame:
    """Rejected rows per (feed, reason)."""
    return rejects(route_all(raw)).groupBy("feed", "reason").agg(F.count(F.lit(1)).alias("n_rows"))


def accounting(routed: dict[str, DataFrame]) -> DataFrame:
    """``(feed, raw_rows, accepted_rows, superseded_rows, rejected_rows)``: the last three add up to the first."""
    parts = []
    for feed, df in routed.items():
        superseded = F.count_if(F.col("reason") == "superseded")
        parts.append(df.agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(F.col("accepted") == 1).alias("accepted_rows"), superseded.alias("superseded_rows"),
                            F.count_if((F.col("accepted") == 0) & (F.col("reason") != "superseded")).alias("rejected_rows")).select(F.lit(feed).alias("feed"), "*"))
    return reduce(DataFrame.unionByName, parts)
