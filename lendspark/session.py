"""Spark session helpers.

The library never creates a session on its own inside an operator; these
helpers are for scripts, tests and the benchmark.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job in this package assumes: UTC wall clock (date parsing
# and period strings), adaptive execution (runtime broadcast of small
# aggregated sides, skew-join splitting, partition coalescing).
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def compile_wide_rows(spark: SparkSession) -> None:
    """Let tables of some sixty columns run compiled. Spark makes one method
    of a projection, and the JVM leaves methods over 8000 bytes of code
    interpreted; with this limit Spark cuts such projections into small
    methods. A limit that the session has set itself stays."""
    if spark.conf.get(METHOD_LIMIT, None) in (None, "65535"):
        spark.conf.set(METHOD_LIMIT, "8000")


def build_session(
    master: str | None = None,
    app_name: str = "lendspark",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    ``master`` defaults to ``local[$BENCH_CPUS]`` or ``local[*]``; on a
    cluster pass ``None`` and let ``spark-submit`` decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None:
        cpus = os.environ.get("BENCH_CPUS")
        master = f"local[{cpus}]" if cpus else "local[*]"
    builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if extra_conf:
        conf.update(extra_conf)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

