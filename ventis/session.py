"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution re-plans joins from real stage sizes and splits skewed join partitions.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


_scope = threading.local()


def build_session(
    app_name: str = "ventis", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """Session with adaptive execution on and UTC as the session zone."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        **ADAPTIVE_CONF,
        "spark.sql.session.timeZone": "UTC",
        # Do not record the Python call site of every expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or else the session's warehouse.

    Both are locations of the cluster's own file system; a machine-local temporary folder is
    never made.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/ventis/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder of this application in the shared folder."""
    path = f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage like a reliable checkpoint and survives executor loss. Later readers still
    prune columns and push filters into the Parquet scan, and joins are planned from the real
    size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark writes; an absent one is no error."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables made in this block by this thread when it ends.

    For work whose results are written or collected inside: frames that read these tables stop
    working.
    """
    outer = getattr(_scope, "paths", None)
    _scope.paths = []
    try:
        yield
    finally:
        made, _scope.paths = _scope.paths, outer
        for path in made:
            delete_path(spark, path)


def drop_materialized(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; frames that read them stop working."""
    delete_path(spark, _own_folder(spark))
