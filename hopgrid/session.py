"""Session settings and the shared working folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Plan settings that matter here. They are defaults only: a cluster's own
# configuration wins, see ``build_session``.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Recording the Python line of every column expression doubles the time to build a query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "hopgrid", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="hopgrid-")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
        base = _local_dir()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Remove a working folder, wherever it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def rename_files(spark: SparkSession, folder: str, pattern: str, into: str, suffix: str) -> None:
    """Give files a name that Spark's writers cannot give: a number and ``suffix``, in the folder ``into``."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for n, status in enumerate(store.globStatus(path(folder, pattern))):
        store.rename(status.getPath(), path(into, f"{n}{suffix}"))
