"""Session settings and the shared folder for cut lineage and scratch tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "riskweave", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session with the settings the library expects."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("RISKWEAVE_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """All instants are UTC: feeds, hours, weekdays and casts depend on it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder shared by all executors: ``spark.checkpoint.dir`` of the session.

    Without the setting a session inside one process, as in tests, gets a folder of its
    own, which goes when the process ends. On a cluster the missing setting is an error,
    because a machine-local path would not survive the loss of an executor.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="riskweave-")
        _file_system(spark, configured)[0].deleteOnExit(_file_system(spark, configured)[1])
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in its terms."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, wherever it is stored."""
    system, hadoop = _file_system(spark, path)
    system.delete(hadoop, True)


def rename_folder(spark: SparkSession, path: str, target: str) -> None:
    """Give a folder another name, which must not be taken."""
    system, hadoop = _file_system(spark, path)
    if not system.rename(hadoop, _file_system(spark, target)[1]):
        raise RuntimeError(f"{path} cannot become {target}")


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder.

    It is deleted when the session's process ends, or with the ``scratch_scope`` it was
    made in.
    """
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    system, hadoop = _file_system(spark, path)
    system.deleteOnExit(hadoop)
    for scope in _SCOPES[-1:]:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes the scratch paths made inside, at its end; what is read from them must be done."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.remove(made)
        for path in made:
            delete_folder(spark, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage like a checkpoint, but columnar: later readers prune columns and
    the optimizer knows the size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def use_rocksdb_state(spark: SparkSession) -> SparkSession:
    """Streaming state in RocksDB: it spills to disk, and custom processors need it."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return spark


@contextmanager
def state_partitions(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """``partitions`` state partitions for a stateful query started inside.

    Their number is fixed at the first start of a query, whatever the cluster grows to, so
    it is the caller's choice; the default leaves the session's setting. It cannot be
    coalesced at run time, and every partition has its own store.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if partitions is not None:
        spark.conf.set(name, str(partitions))
    try:
        yield
    finally:
        spark.conf.set(name, before)
