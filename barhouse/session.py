"""Session construction and the scratch area shared by all executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "barhouse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    Nothing here is needed for right results; AQE splits skewed joins and
    coalesces small shuffles, and UTC keeps naive timestamps naive.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benches on one machine."""
    parts = "8" if cores == "*" else str(cores)
    return build_session(
        master=f"local[{cores}]",
        **{
            "spark.sql.shuffle.partitions": parts,
            # Listing a few thousand local folders is faster without a job.
            "spark.sql.sources.parallelPartitionDiscovery.threshold": "10000",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            # Local files need no checksum sidecars.
            "spark.hadoop.fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
            **conf,
        },
    )


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Where that is
    unset, a session that runs on this machine alone uses the system's temporary
    folder; on a cluster executors would not see each other's files, so it fails.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/barhouse/{name}-{uuid.uuid4().hex}"
