"""Session helpers: building a session for tests/bench, and locating the
shared folder used to cut lineage (``spark.checkpoint.dir``)."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "corpusmill") -> SparkSession:
    """Session for tests and the bench. On a cluster, use the session the
    platform hands you; nothing here is required by the library."""
    builder = (
        SparkSession.builder.master(master or "local[*]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CORPUSMILL_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and work tables.

    Read from the session (``spark.checkpoint.dir`` / the SparkContext). Only
    when it is unset *and* the master is local (tests, bench) is a private
    folder created; on a cluster an unset directory is an error, because a
    machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - absent key raises on some versions
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/GCS) before running operators that cut lineage")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="corpusmill-ckpt-"))
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a work table below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/work/{name}-{uuid.uuid4().hex}"


_SHIPPED_APPS: set[str] = set()
_PACKAGE_ZIP: str | None = None


def ship_package(spark: SparkSession) -> None:
    """Make ``corpusmill`` importable in the Python workers of this
    application (``addPyFile`` of a zip of the package, once per
    application). Operators that run Python inside tasks (listing, content
    reading, pluggable converters) call it, so they work however the session
    was started; on a cluster ``--py-files`` does the same up front."""
    global _PACKAGE_ZIP
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED_APPS:
        return
    if _PACKAGE_ZIP is None:
        import shutil
        pkg_dir = os.path.dirname(os.path.abspath(__file__))
        out = tempfile.mkdtemp(prefix="corpusmill-pkg-")
        _PACKAGE_ZIP = shutil.make_archive(os.path.join(out, "corpusmill"), "zip",
                                           root_dir=os.path.dirname(pkg_dir), base_dir="corpusmill")
    source = _PACKAGE_ZIP
    if not sc.master.startswith("local"):
        # executors fetch the zip from the shared folder, not from a path on the driver
        jvm = sc._jvm
        target = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/pkg/corpusmill.zip")
        fs = target.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.copyFromLocalFile(False, True, jvm.org.apache.hadoop.fs.Path(_PACKAGE_ZIP), target)
        source = target.toString()
    sc.addPyFile(source)
    _SHIPPED_APPS.add(sc.applicationId)
