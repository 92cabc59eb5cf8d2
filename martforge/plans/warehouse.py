"""End-to-end pipeline: land -> stage -> dims -> facts -> contract and gate -> publish.

The row rules of the marts are counted by the writes themselves, their keys and references
on the written versions (``operators.contracts``); a build that breaks a rule or a
data-quality check publishes nothing.  A good one publishes all marts by one log entry.

Two runs are applied to the driver's tables (see ``sources.fixtures``): the
first creates every dimension, the second brings a customer snapshot with
movers and opt-in flips, so the SCD2 dimension carries real history when the
facts are built.  Every layer that is read more than once is written to the
shared checkpoint folder and read back: later stages start from files
(lineage cut, executor-loss safe) and the planner sees true table sizes when
it decides on broadcasts.

Independent tables of a step (e.g. the four dimensions of a run) are written
as concurrent Spark jobs from a small thread pool, so that small or narrow
jobs do not leave executors idle while they wait for each other.
"""

from __future__ import annotations

import hashlib
import json
import os
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from martforge import schemas as S
from martforge.operators import contracts
from martforge.operators.quality import dq_enforce, dq_report
from martforge.plans import dims, facts, staging
from martforge.sources import fixtures
from martforge.sources.store import TableStore

MAX_CONCURRENT_JOBS = 4
RELEASE = "warehouse"


@dataclass
class Warehouse:
    """Materialised tables of one pipeline build, by layer-qualified name."""
    tables: dict[str, DataFrame] = field(default_factory=dict)
    versions: dict[str, str] = field(default_factory=dict)   # of the published marts, by table name in the store

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def marts(self) -> dict[str, DataFrame]:
        return {k.split(".", 1)[1]: v for k, v in self.tables.items() if k.startswith("marts.")}


_BUILT: dict[tuple[str, str], Warehouse] = {}
_BUILD_LOCK = threading.Lock()


def _concurrently(jobs: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    if len(jobs) == 1:
        return {k: f() for k, f in jobs.items()}
    with ThreadPoolExecutor(max_workers=min(MAX_CONCURRENT_JOBS, len(jobs))) as pool:
        futures = {k: pool.submit(f) for k, f in jobs.items()}
        return {k: fut.result() for k, fut in futures.items()}


def build_from_feeds(spark: SparkSession, runs: list[tuple[dict[str, DataFrame], str]], store: TableStore | None = None,
                     materialize: bool = True, gate: bool = True) -> Warehouse:
    """Apply each (raw feeds, run_ts) load in order; returns the final tables.

    Dimensions accumulate across runs (insert-if-absent, SCD1 upsert, SCD2);
    staging and facts are full refreshes of the last run.  With ``gate`` (the
    default) the marts' contract and the data-quality suite must hold before the
    build is published and returned: a failing build is never reused or published.
    """
    store = store or TableStore(spark)
    w = Warehouse()
    observed: dict[str, list[contracts.Violations]] = {}

    def keep(name: str, df: DataFrame) -> Callable[[], DataFrame]:
        layer, table = name.rsplit(".", 2)[-2:]
        if not materialize:
            return lambda: df
        if layer != "marts":
            return lambda: store.materialize(name, df)

        def write() -> DataFrame:
            version, written, observed[table] = contracts.write_observed(store, name, df, table, S.MART_CONTRACTS[table])
            w.versions[name] = version
            return written
        return write

    d_date = dims.empty(spark, dims.DIM_DATE_SCHEMA)
    d_geo = dims.empty(spark, dims.DIM_GEOGRAPHY_SCHEMA)
    d_cust = dims.empty(spark, dims.DIM_CUSTOMER_SCHEMA)
    d_prod = dims.empty(spark, dims.DIM_PRODUCT_SCHEMA)
    stg: dict[str, DataFrame] = {}
    for i, (raw, run_ts) in enumerate(runs, start=1):
        last = i == len(runs)
        # Staging feeds the dimensions of the same run; only the last run's
        # staging also feeds the facts, so earlier runs write customers only
        # (read by three dimension builds) and leave the rest lazy.
        cust = keep(f"run{i}.staging.customers", staging.stage_customers(raw["customers"]))()
        prod = staging.stage_products(raw["products"])
        orders = staging.stage_orders(raw["orders"], cust)
        sessions = staging.stage_sessions(raw["sessions"], cust)
        if last:
            done = _concurrently({"products": keep(f"run{i}.staging.products", prod),
                                  "orders": keep(f"run{i}.staging.orders", orders),
                                  "sessions": keep(f"run{i}.staging.sessions", sessions)})
            prod, orders, sessions = done["products"], done["orders"], done["sessions"]
        items = staging.stage_order_items(raw["order_items"], orders, prod)
        stg = {"customers": cust, "products": prod, "orders": orders, "order_items": items, "sessions": sessions}
        w.tables[f"run{i}.staging.customers"] = cust
        w.tables[f"run{i}.marts.dim_customer_before"] = d_cust
        w.tables[f"run{i}.marts.dim_geography_before"] = d_geo
        jobs = {
            "date": keep(f"run{i}.marts.dim_date", dims.dim_date(d_date, stg)),
            "geo": keep(f"run{i}.marts.dim_geography", dims.dim_geography(d_geo, cust)),
            "cust": keep(f"run{i}.marts.dim_customer", dims.dim_customer(d_cust, cust, run_ts)),
            "prod": keep(f"run{i}.marts.dim_product", dims.dim_product(d_prod, prod)),
        }
        if last:
            jobs["items"] = keep(f"run{i}.staging.order_items", items)
        done = _concurrently(jobs)
        d_date, d_geo, d_cust, d_prod = done["date"], done["geo"], done["cust"], done["prod"]
        if last:
            stg["order_items"] = done["items"]
        w.tables[f"run{i}.marts.dim_geography"] = d_geo
    for k, v in stg.items():
        w.tables[f"staging.{k}"] = v
    w.tables.update({"marts.dim_date": d_date, "marts.dim_geography": d_geo,
                     "marts.dim_customer": d_cust, "marts.dim_product": d_prod})
    # Facts are written clustered by their date key within each file (a local
    # sort, no shuffle), so Parquet min/max statistics let date-range filters
    # such as the RFM window skip row groups instead of reading everything.
    done = _concurrently({
        "fact_orders": keep("marts.fact_orders", facts.fact_orders(stg["orders"], stg["order_items"], d_prod, d_cust)
                            .sortWithinPartitions("order_date_key")),
        "fact_sessions": keep("marts.fact_sessions", facts.fact_sessions(stg["sessions"], d_cust)
                              .sortWithinPartitions("session_date_key")),
    })
    w.tables["marts.fact_orders"] = done["fact_orders"]
    w.tables["marts.fact_sessions"] = done["fact_sessions"]
    if materialize:
        enforce_and_publish(spark, store, w, observed, gate)
    elif gate:
        dq_enforce(dq_report(w["marts.fact_orders"], d_cust, d_prod))
    return w


def enforce_and_publish(spark: SparkSession, store: TableStore, w: Warehouse, observed: dict[str, list[contracts.Violations]], gate: bool = True) -> None:
    """Check the written marts; publish them, with their contract report, as one release."""
    marts = {t: w[f"marts.{t}"] for t in S.MART_CONTRACTS}
    counts = [v for t in S.MART_CONTRACTS for v in observed[t]]
    counts += [contracts.Violations(*r) for r in contracts.key_report(marts, S.MART_CONTRACTS).collect()]  # one row per rule
    if gate:
        if contracts.broken(counts):
            raise contracts.ContractError(contracts.broken(counts))
        dq_enforce(dq_report(marts["fact_orders"], marts["dim_customer"], marts["dim_product"]))
    w.tables["checks.marts"] = store.materialize("checks.marts", contracts.report_frame(spark, counts).coalesce(1))
    last = {name.rsplit(".", 1)[-1]: name for name in w.versions}   # of a dimension the last run's table
    store.publish_release(RELEASE, {name: w.versions[name] for name in last.values()})


def fixture_runs(spark: SparkSession, sf_dir: str, store: TableStore | None = None) -> list[tuple[dict[str, DataFrame], str]]:
    """The two loads of the fixture, landed: the raw feeds are written once as
    the raw layer (all text + load time) and every later step reads them.
    The second load differs from the first only in its customer snapshot."""
    store = store or TableStore(spark)
    first = fixtures.raw_feeds(spark, sf_dir, snapshot=1)
    jobs = {name: (lambda n=name, df=df: store.materialize(f"raw.{n}", df)) for name, df in first.items()}
    jobs["customers_2"] = lambda: store.materialize("raw.customers_2", fixtures.raw_customers(spark, sf_dir, snapshot=2))
    landed = _concurrently(jobs)
    run1 = {name: landed[name] for name in first}
    run2 = {**run1, "customers": landed["customers_2"]}
    return [(run1, fixtures.RUN_TS_1), (run2, fixtures.RUN_TS_2)]


def _build_id(sf_dir: str) -> str | None:
    """Identity of a build: the library's code and the input files (size, mtime).

    None when the inputs cannot be fingerprinted (not a local path); such builds
    are not reused across processes.
    """
    h = hashlib.sha1(sf_dir.rstrip("/").encode())
    pkg = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for root, _, files in sorted(os.walk(pkg)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(root, f), "rb") as fh:
                    h.update(fh.read())
    for t in fixtures.INPUT_TABLES:
        path = f"{sf_dir.rstrip('/')}/{t}.parquet"
        if not os.path.exists(path):
            return None
        st = os.stat(path)
        h.update(f"{t}:{st.st_size}:{st.st_mtime_ns}".encode())
    return h.hexdigest()[:20]


def _save_manifest(spark: SparkSession, store: TableStore, build_id: str, w: Warehouse) -> None:
    """Record where every table of a finished build lives (written last: a partial build has none)."""
    entries = []
    for name, df in w.tables.items():
        files = df.inputFiles()
        location = os.path.dirname(files[0]) if files else ""
        entries.append((name, location, df.schema.json()))
    spark.createDataFrame(entries, "name string, location string, schema string").coalesce(1) \
        .write.mode("overwrite").json(f"{store.root}/builds/{build_id}")


def _load_manifest(spark: SparkSession, store: TableStore, build_id: str) -> Warehouse | None:
    try:
        entries = spark.read.schema("name string, location string, schema string").json(f"{store.root}/builds/{build_id}").collect()
    except Exception:  # no manifest yet
        return None
    if not entries:
        return None
    w = Warehouse()
    for e in entries:
        schema = T.StructType.fromJson(json.loads(e["schema"]))
        w.tables[e["name"]] = spark.read.schema(schema).parquet(e["location"]) if e["location"] else spark.createDataFrame([], schema)
    return w


_LANDED: dict[tuple[str, str], list[tuple[dict[str, DataFrame], str]]] = {}


def _saved(spark: SparkSession, sf_dir: str) -> Warehouse | None:
    """The finished build of this application, or one of the same code and inputs by another."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _BUILT:
        build_id = _build_id(sf_dir)
        w = _load_manifest(spark, TableStore(spark), build_id) if build_id else None
        if w is None:
            return None
        _BUILT[key] = w
    return _BUILT[key]


def _landed(spark: SparkSession, sf_dir: str) -> list[tuple[dict[str, DataFrame], str]]:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _LANDED:
        _LANDED[key] = fixture_runs(spark, sf_dir)
    return _LANDED[key]


def landed(spark: SparkSession, sf_dir: str) -> list[tuple[dict[str, DataFrame], str]]:
    """The loads of ``fixture_runs``, landed once: queries on raw feeds need no finished build."""
    with _BUILD_LOCK:
        w = _saved(spark, sf_dir)
        if w is None:
            return _landed(spark, sf_dir)
        return [({feed: w[f"run{i}.raw.{feed}"] for feed in S.FEEDS}, ts) for i, ts in enumerate((fixtures.RUN_TS_1, fixtures.RUN_TS_2), start=1)]


def warehouse(spark: SparkSession, sf_dir: str, reuse_saved: bool = True) -> Warehouse:
    """The fixture warehouse for ``sf_dir``: built once, then reused.

    Within a Spark application the build is memoised; across processes a
    finished build with the same code and inputs is read back from its
    manifest in the shared store (``reuse_saved=False`` always builds, as the
    benchmark does).
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _BUILD_LOCK:   # concurrent callers share one build
        if key in _BUILT:
            return _BUILT[key]
        store = TableStore(spark)
        build_id = _build_id(sf_dir)
        w = _saved(spark, sf_dir) if reuse_saved else None
        if w is None:
            runs = _landed(spark, sf_dir)
            w = build_from_feeds(spark, runs, store)
            for i, (raw, _) in enumerate(runs, start=1):
                for name, df in raw.items():
                    w.tables[f"run{i}.raw.{name}"] = df
            if build_id:
                _save_manifest(spark, store, build_id, w)
        _BUILT[key] = w
        return w
