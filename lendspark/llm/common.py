"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a maximal run of characters outside ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id counts as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder in ``spark.checkpoint.dir``.

    The setting is read from the session. Only a local session may go
    without it; then the warehouse folder is used. A cluster session
    without it is refused, since a machine-local folder would not be seen
    by the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again.

    This cuts the lineage and gives the planner exact sizes, so that later
    joins broadcast only what is known to be small.
    """
    path = scratch_dir(df.sparkSession, label)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def filesystem(uri: str):
    """(pyarrow file system, path) of a folder name or URI."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


# What a worker process keeps from task to task, by the name of the operator.
KEPT: dict[str, dict] = {}


def _give_back() -> None:
    """Freed memory goes to the system instead of waiting for the next task."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU library
        pass


def _tidied(run: Callable, keeps: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for name in [k for k in KEPT if k != keeps]:
        del KEPT[name]
    try:
        yield from run(batches)
    finally:
        _give_back()


def tidy(run: Callable, keeps: str = "") -> Callable:
    """``run`` (a function for ``mapInArrow``) in a worker that serves other
    operators too: what they keep goes at the start, freed memory at the end."""

    def tidied(batches):
        return _tidied(run, keeps, batches)

    return tidied


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ship(query):
    """Let Python workers import this package: once a session, its sources
    are put into the shared folder as a zip file and added to the job's files
    (as ``--py-files`` does). Wraps functions whose first argument is the
    session."""
    import functools
    import io
    import os
    import zipfile

    name = "lendspark_sources.zip"

    @functools.wraps(query)
    def run(spark: SparkSession, *args, **options):
        if not any(f.endswith(name) for f in spark.sparkContext.listFiles):
            root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
            held = io.BytesIO()
            with zipfile.ZipFile(held, "w") as z:
                for folder, _, files in os.walk(root):
                    for f in sorted(files):
                        if f.endswith(".py"):
                            path = os.path.join(folder, f)
                            z.write(path, os.path.relpath(path, os.path.dirname(root)))
            uri = scratch_dir(spark, "sources")
            fs, path = filesystem(uri)
            fs.create_dir(path, recursive=True)
            with fs.open_output_stream(f"{path}/{name}", compression=None) as out:
                out.write(held.getvalue())
            spark.sparkContext.addPyFile(f"{uri}/{name}")
        return query(spark, *args, **options)

    return run
