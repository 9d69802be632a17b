"""Session helper: the settings that the engine's results depend on, and those it runs best with."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def session(app: str = "quire", cpus: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and benches. On a cluster, build the session with spark-submit instead."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("QUIRE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's URI below spark.checkpoint.dir. Only a local session, as in tests, may leave that unset."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    base = base or tempfile.mkdtemp(prefix="quire-")
    if "://" not in base:
        path = spark._jvm.org.apache.hadoop.fs.Path(base)
        base = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
        base = "file://" + base.removeprefix("file:") if base.startswith("file:/") and not base.startswith("file://") else base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
