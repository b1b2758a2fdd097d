"""Session set-up and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM interprets methods above 8000 bytes of bytecode instead of compiling them.
    # Wide parsing projections exceed that when fused, so Spark is told to split them.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording a call site per column expression doubles the time to build wide plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Shuffle files go when their statement ends. Otherwise a load of many statements keeps
    # those of all of them until the driver happens to collect garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
RUNTIME = ["spark.sql.codegen.hugeMethodLimit", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"]
#: Of stored tables: hashes in hex take half the space, repeated payload keys hardly any.
CODEC = "zstd"


def get_session(name: str = "millwright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings that can still change on a running session."""
    for key in RUNTIME:
        spark.conf.set(key, DEFAULTS[key])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder takes its place in a local session, whose
    executors are the driver's own threads; on a cluster it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="millwright-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession):
    """Deletes the scratch paths made inside it when it ends.

    For a job whose results are written or collected before its end: a DataFrame that still
    reads a scratch table cannot be used afterwards.
    """
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield paths
    finally:
        # By identity: two scopes may list the same paths, none for instance.
        _scopes[:] = [s for s in _scopes if s is not paths]
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; the innermost ``scratch_scope`` deletes it."""
    path = f"{shared_dir(spark).rstrip('/')}/millwright/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several later statements need the same rows and recomputing them
    could give other rows or cost another full scan; survives lost executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
