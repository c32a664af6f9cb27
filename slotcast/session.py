"""Session helpers: local session for tests/bench, and the shared folder.

Scratch tables are written under the folder the cluster names in
``spark.checkpoint.dir`` (read from the session).  Only when that setting is
unset -- local runs and tests -- do we pick our own folder.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "slotcast") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Shared folder for scratch tables: the session's checkpoint folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = os.path.join(tempfile.gettempdir(), f"slotcast-ckpt-{uuid.uuid4().hex[:8]}")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder below the shared root."""
    return "/".join([shared_root(spark).rstrip("/"), "runs", uuid.uuid4().hex, *parts])


def source_stamp(spark: SparkSession, folder: str, table: str = "events") -> str:
    """Changes whenever the files of an input table do: from their number, sizes and times."""
    fs, path = _fs(spark, f"{folder}/{table}.parquet")
    if not fs.exists(path):
        return "none"
    seen = [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path)]
    return hashlib.sha256(repr(sorted(seen)).encode()).hexdigest()[:12]


def store_path(spark: SparkSession, name: str, key: str) -> str:
    """A folder below the shared root for tables reused across calls, as long as the input ``key`` stays as it is."""
    safe = "".join(ch if ch.isalnum() else "_" for ch in key)
    return "/".join([shared_root(spark).rstrip("/"), "stores", f"{safe}_{source_stamp(spark, key)}", name])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return bool(fs.exists(jpath))


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder."""
    fs, jpath = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(jpath)]


def bytes_under(spark: SparkSession, path: str) -> int:
    fs, jpath = _fs(spark, path)
    return int(fs.getContentSummary(jpath).getLength())


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of ours, for intermediates that nothing reads any more."""
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, as a mark."""
    fs, jpath = _fs(spark, path)
    fs.create(jpath, True).close()


def table_ready(spark: SparkSession, path: str) -> bool:
    """True when a committed write (``_SUCCESS`` marker) sits at ``path``."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def mark_ready(spark: SparkSession, path: str) -> None:
    """Write the ``_SUCCESS`` marker at a table root.  Dynamic partition
    overwrite commits partition folders only, so the marker is set here."""
    fs, jpath = _fs(spark, path.rstrip("/") + "/_SUCCESS")
    if not fs.exists(jpath):
        fs.create(jpath, True).close()
