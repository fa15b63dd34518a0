"""Session settings for local runs, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = 8, app: str = "tremorline", memory: str = "8g", scratch: str | None = None
) -> SparkSession:
    """A session for tests and benchmarks. Clusters bring their own.

    scratch: the folder for intermediate tables, as `spark.checkpoint.dir`.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if scratch:
        builder = builder.config("spark.checkpoint.dir", scratch)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder that the session names.

    That is `spark.checkpoint.dir`, or the warehouse where it is unset: both are
    reached by the driver and by every executor. The session removes the folder
    when it ends, so results that are lazily read from it stay good until then.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{shared.rstrip('/')}/tremorline-{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder
