"""Versioned Parquet tables in the cluster's shared checkpoint folder.

Full refresh never overwrites the files a reader may be scanning: every write
goes to a fresh version directory, and only then one line that names it is appended to
the table's log (an ordinary JSON table).  Nothing is ever deleted or rewritten:
a failed write, gate or append leaves the previous version live.  Written tables also cut lineage for later stages and
survive the loss of executors, which cached blocks would not.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.session import checkpoint_root

_LOG = "number long, version string"
_RELEASES = "number long, entry string, tables map<string, string>"
ROW_GROUP = 16 << 20    # bytes: a scan cannot cut a file finer than its row groups


class TableStore:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or f"{checkpoint_root(spark)}/martforge-store").rstrip("/")

    def _pointer(self, name: str) -> str:
        return f"{self.root}/{name}/_CURRENT"

    def write_version(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> str:
        """Write ``df`` as a new, not yet published version; returns the version id."""
        version = uuid.uuid4().hex[:12]
        w = df.write.mode("errorifexists").format("parquet").option("parquet.block.size", ROW_GROUP)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(f"{self.root}/{name}/v={version}")
        return version

    def publish(self, name: str, version: str) -> None:
        """Append ``version`` to the table's log; the entry with the highest number is the live one."""
        last = self._last(name)
        self.spark.createDataFrame([((last["number"] if last else 0) + 1, version)], _LOG).coalesce(1) \
            .write.mode("append").json(self._pointer(name))

    def _last(self, name: str):
        try:
            log = self.spark.read.schema(_LOG).json(self._pointer(name))
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None  # never published
            raise
        return log.where("version IS NOT NULL").orderBy(F.col("number").desc(), "version").first()

    def current_version(self, name: str) -> str | None:
        """The live version, or None if the table was never published; any other read error is raised."""
        last = self._last(name)
        return last["version"] if last else None

    def read(self, name: str, version: str | None = None, schema=None) -> DataFrame:
        """Read a version (default: the published one).  A known ``schema``
        skips the footer-reading job that schema inference would start."""
        version = version or self.current_version(name)
        if version is None:
            raise KeyError(f"table {name} has no published version")
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return reader.parquet(f"{self.root}/{name}/v={version}")

    # --- releases: one entry publishes all tables of a build ---
    def publish_release(self, release: str, versions: dict[str, str]) -> int:
        """Append one entry that names the version of every table; readers see all of them or none.

        If another writer took the same number meanwhile, the entry is repeated with the
        next one, so that every successful publication was the live one at its time.
        """
        log, entry = f"{self.root}/_RELEASES/{release}", uuid.uuid4().hex
        while True:
            last = self.last_release(release)
            number = (last["number"] if last else 0) + 1
            self.spark.createDataFrame([(number, entry, versions)], _RELEASES).coalesce(1).write.mode("append").json(log)
            if self.spark.read.schema(_RELEASES).json(log).where(F.col("number") >= number).select("entry").distinct().count() == 1:
                return number

    def last_release(self, release: str):
        try:
            log = self.spark.read.schema(_RELEASES).json(f"{self.root}/_RELEASES/{release}")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return log.where("entry IS NOT NULL").orderBy(F.col("number").desc(), "entry").first()

    def read_release(self, release: str) -> dict[str, DataFrame]:
        """All tables of the live release; empty if there is none."""
        last = self.last_release(release)
        return {name: self.read(name, version) for name, version in last["tables"].items()} if last else {}

    def refresh(self, name: str, df: DataFrame, partition_by: list[str] | None = None, gate=None) -> DataFrame:
        """Full refresh: write a new version, run ``gate(new_df)`` (may raise), then publish."""
        version = self.write_version(name, df, partition_by)
        fresh = self.read(name, version)
        if gate is not None:
            gate(fresh)
        self.publish(name, version)
        return fresh

    def materialize(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """Write a private version and read it back: a lineage cut that survives executor loss.

        Nothing is published (no pointer move); use ``refresh`` for that.
        """
        version = self.write_version(name, df, partition_by)
        return self.read(name, version, schema=df.schema)
