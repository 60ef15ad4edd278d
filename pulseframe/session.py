"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)
STATE_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
_scratch: list[str] = []


def get_spark(app: str = "pulseframe", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every operator here relies on.

    Nothing sizes the cluster: partition counts stay with AQE and the submitter.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(STATE_PROVIDER_KEY, ROCKSDB_PROVIDER)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the cluster's shared checkpoint folder.

    The folder is ``spark.checkpoint.dir`` (or whatever was given to
    ``setCheckpointDir``). Only a local-mode session may fall back to a
    machine-local folder, because there every task runs on this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="pulseframe-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def drop_scratch() -> None:
    """Delete what this application wrote to scratch paths; results that read it end here.

    Runs by itself when the driver's Python ends; a long session may call it between jobs.
    """
    if SparkContext._gateway is None:
        return
    jvm, context = SparkContext._gateway.jvm, SparkContext._active_spark_context
    conf = context._jsc.hadoopConfiguration() if context else jvm.org.apache.hadoop.conf.Configuration()
    while _scratch:
        path = jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(conf).delete(path, True)


@atexit.register
def _drop_scratch_at_exit() -> None:
    try:
        drop_scratch()
    except Exception:  # the JVM may be gone already
        pass


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever they run.

    Once per application; a package installed on the cluster needs no shipping but
    is not disturbed by it.
    """
    context = spark.sparkContext
    if getattr(context, "_pulseframe_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="pulseframe-"), "pulseframe")
    root, name = os.path.split(package)
    context.addPyFile(shutil.make_archive(target, "zip", root, name))
    # The process that sets up streaming state runs next to the driver and sees no shipped files.
    paths = [root, context.environment.get("PYTHONPATH", "")]
    context.environment["PYTHONPATH"] = os.pathsep.join(p for p in paths if p)
    context._pulseframe_shipped = True
