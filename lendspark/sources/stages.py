"""Stage tables: intermediate results written as Parquet and read again.

A stage cuts the lineage, gives later plans exact sizes (so the planner's
broadcast decisions rest on bytes), and lets each reader prune columns.

Inside a :class:`Run`, stage tables are named by the run's inputs and
parameters and entered in a manifest when they are complete; the same run
started again takes the entered ones instead of computing them.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

_ACTIVE: ContextVar[Run | None] = ContextVar("active_run", default=None)


def stage_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    It is read from the session. A local session without it uses the
    warehouse folder; any other session without it is refused, since a
    machine-local folder would not be seen by the other executors.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if sc.master == "local" or sc.master.startswith("local["):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` under the shared folder and return a scan of it; in a
    :class:`Run`, take the table of the run's manifest where there is one."""
    run = _ACTIVE.get()
    if run is not None:
        return run.stage(df, label)
    path = f"{stage_root(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_by_key(df: DataFrame, key: str = "row_id", buckets: int | None = None, label: str = "keyed") -> DataFrame:
    """A stage table in ``buckets`` buckets by ``key``, sorted inside each.
    Joins and groupings by the key of tables with the same number of buckets
    need no exchange."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
    rows = df.repartition(buckets, F.col(f"`{key}`"))
    rows.write.bucketBy(buckets, key).sortBy(key).option("path", f"{stage_root(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def fingerprint(spark: SparkSession, path: str) -> list:
    """Names, sizes and times of the files under ``path``; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    rows = files.select("path", "length", F.unix_micros("modificationTime").alias("t")).collect()
    return sorted([r["path"], r["length"], r["t"]] for r in rows)


class Run:
    """A run whose stage tables outlive its driver.

    ``with Run(spark, folder, inputs=[...], params={...}):`` makes every
    :func:`stage` inside one of the run's. The run is named by its inputs'
    files and its parameters, a table by its place in the run, its label and its
    columns. A table is entered in the manifest after it is written whole, so
    a run that died leaves complete tables or none. The code inside must make
    the same stages in the same order each time. ``taken`` and ``written``
    count the tables found and made.
    """

    def __init__(self, spark: SparkSession, folder: str, inputs: Sequence[str] = (), params: dict | None = None):
        said = json.dumps([[fingerprint(spark, p) for p in inputs], params or {}], sort_keys=True, default=str)
        self.spark, self.name = spark, hashlib.sha256(said.encode()).hexdigest()[:24]
        self.folder = f"{folder.rstrip('/')}/run-{self.name}"
        self.place = self.taken = self.written = 0
        self.manifest = {r["table"]: r["path"] for r in self._entries()}

    def _entries(self) -> list:
        try:
            return self.spark.read.schema("table string, path string").parquet(f"{self.folder}/manifest").collect()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return []
            raise

    def __enter__(self) -> Run:
        self._token = _ACTIVE.set(self)
        self.place = self.taken = self.written = 0
        return self

    def __exit__(self, *_) -> None:
        _ACTIVE.reset(self._token)

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        columns = hashlib.sha256(df.schema.json().encode()).hexdigest()[:8]
        table = f"{self.place:04d}-{label}-{columns}"
        self.place += 1
        if table in self.manifest:
            self.taken += 1
        else:
            path = f"{self.folder}/{table}-{uuid.uuid4().hex[:8]}"
            df.write.parquet(path)
            entry = self.spark.createDataFrame([(table, path)], "table string, path string")
            entry.coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")
            self.manifest[table] = path
            self.written += 1
        return self.spark.read.schema(df.schema).parquet(self.manifest[table])

    def clean_up(self, everything: bool = False) -> list[str]:
        """Remove the run's folders that the manifest does not name (of tables
        that were cut off), or the whole run; returns what was removed."""
        if everything:
            _remove(self.spark, self.folder)
            self.manifest = {}
            return [self.folder]
        known = {p.rsplit("/", 1)[1] for p in self.manifest.values()} | {"manifest"}
        gone = [f"{self.folder}/{n}" for n in _names(self.spark, self.folder) if n not in known]
        for path in gone:
            _remove(self.spark, path)
        return gone


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _hadoop(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)
