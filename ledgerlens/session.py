"""Session set-up and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Time values are compared in UTC throughout; everything else is left to
# adaptive execution unless the caller or the cluster says otherwise.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.filterPushdown": "true",
}


# Working folders of local-mode sessions, by application.
_local_dirs: dict[str, str] = {}


def build_session(app_name: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` wins over them.

    Master, memory and executor counts come from the submit command.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A local-mode session without the setting gets a folder of its own; on a
    cluster a missing setting is an error, since a machine-local folder would
    lose data with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        _local_dirs[application] = tempfile.mkdtemp(prefix="ledgerlens-")
    return _local_dirs[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system a path lies on, and the path as it knows it."""
    known = spark._jvm.org.apache.hadoop.fs.Path(path)
    return known.getFileSystem(spark._jsc.hadoopConfiguration()), known


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this package has written, on whatever storage it lies."""
    system, known = _file_system(spark, path)
    system.delete(known, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    system, known = _file_system(spark, path)
    return system.exists(known)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Sub-folders, the most recently changed first."""
    system, known = _file_system(spark, path)
    if not system.exists(known):
        return []
    found = [f for f in system.listStatus(known) if f.isDirectory()]
    found.sort(key=lambda f: f.getModificationTime(), reverse=True)
    return [f.getPath().toString() for f in found]
