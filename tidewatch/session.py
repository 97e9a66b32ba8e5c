"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "tidewatch", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the engine relies on; ``conf`` adds to them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def streaming_session(spark: SparkSession) -> SparkSession:
    """A sibling session set up for stateful queries; the caller's is untouched."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # A micro-batch is small in bytes and long in work: a large file is read by as many tasks as there are.
    session.conf.set("spark.sql.files.openCostInBytes", str(1 << 20))
    # Frozen in the checkpoint of a stateful query, so take the caller's value.
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return session


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder, there until the session ends.

    A local temporary folder is used only where that setting is absent and the
    session runs on one machine.
    """
    folder = f"{_shared_base(spark)}/tidewatch/{name}-{uuid.uuid4().hex}"
    path, files = _file_system(spark, folder)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of this engine's own, wherever it is stored."""
    path, files = _file_system(spark, folder)
    files.delete(path, True)


def _file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _shared_base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.gettempdir()
    return base.rstrip("/")
