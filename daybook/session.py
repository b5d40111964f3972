"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("daybook")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name for one run, below the folder that the cluster names.

    ``spark.checkpoint.dir`` must point at storage that every executor sees. Only a
    local session may do without it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = context.applicationId
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="daybook-")
        base = _local_folders[app]
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def saved_table(small: DataFrame, purpose: str) -> DataFrame:
    """A small table of known bound, computed once and read back from the shared folder."""
    path = shared_folder(small.sparkSession, purpose)
    small.repartition(1).write.parquet(path)
    return small.sparkSession.read.schema(small.schema).parquet(path)
