"""Session helpers.

Library code never creates its own session; it receives one.  ``local_session``
is for tests, the bench and the entry point only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "candlewick") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.driver.memory", os.environ.get("CANDLEWICK_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster it is configured and used as is; there, a missing setting is
    an error.  Only a local session, as in tests, gets a private folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):  # executors of local-cluster share no folder
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="candlewick-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``candlewick`` importable in the Python workers of this session.

    The grouped-map kernel and the alert state function live in this package;
    executors receive it as a zip through ``addPyFile`` (once per
    application), so no install on the cluster nodes is needed."""
    import shutil

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    base = os.path.join(tempfile.mkdtemp(prefix="candlewick-pkg-"), "candlewick")
    archive = shutil.make_archive(base, "zip", root_dir=root, base_dir="candlewick")
    sc.addPyFile(archive)
    _SHIPPED.add(app)
