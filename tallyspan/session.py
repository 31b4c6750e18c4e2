"""Session defaults and the shared working folder."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SHARED_DIR_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = 8, app_name: str = "tallyspan", **conf: str) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        # Small test tables would otherwise shrink to fewer tasks than cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.driver.memory", os.environ.get("TALLYSPAN_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    A local session without the setting gets a temporary folder; on a cluster
    a machine-local folder would lose data with its executor, so that is an
    error instead.
    """
    named = spark.conf.get(SHARED_DIR_CONF, None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {SHARED_DIR_CONF} to a folder shared by all executors")
    return _local_folder(spark.conf.get("spark.app.id"))


@functools.cache
def _local_folder(app_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"tallyspan-{app_id}-")


def new_shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for one written table."""
    return f"{shared_dir(spark)}/tallyspan/{name}-{uuid.uuid4().hex}"
