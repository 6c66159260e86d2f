"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings the library relies on. AQE re-plans joins from runtime sizes
# (sort-merge -> broadcast when a side turns out small) and splits skewed
# shuffle partitions; both are on by default in Spark 4 but are stated here so
# that a cluster profile which switched them off is corrected.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def scale_conf(shuffle_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Shuffle sizing from the expected size of the largest shuffle.

    The shuffles here carry narrow, pre-combined rows (ids, a time, a
    category; partial distinct / partial top-k before every exchange), so size
    from the shuffled bytes, not the raw input. Each initial partition holds
    about ``target_partition_bytes`` (no task spills a huge partition),
    clamped to 2..10 partitions per core so the map x reduce block count stays
    sane; AQE then coalesces small partitions to the advisory size and splits
    skewed ones. Scan splits use the same target. E.g. a 5 TB shuffle on
    8000 cores starts with 40k partitions.
    """
    wanted = -(-shuffle_bytes // target_partition_bytes)
    partitions = min(max(wanted, 2 * total_cores), 10 * total_cores)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }


def build_session(
    master: str | None = None,
    app_name: str = "basketry",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session with the library defaults.

    ``master`` is only set when given: on a cluster it comes from spark-submit.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, streaming state and written tables.

    Reads ``spark.checkpoint.dir`` from the session (the cluster names a
    shared, fault-tolerant folder there). Only when it is unset and the driver
    runs all tasks itself (master ``local[...]``, as in tests), a fresh folder
    under the system temp dir is created and set; on a cluster a missing
    setting is an error, as executors would not see a folder of the driver's.
    """
    current = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not current:
        current = _LOCAL_ROOTS.get(id(spark.sparkContext))
    if not current:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder: the master is {master}")
        current = tempfile.mkdtemp(prefix="basketry-ckpt-")
        _LOCAL_ROOTS[id(spark.sparkContext)] = current
    spark.sparkContext.setCheckpointDir(current)
    return current


# Folders made for sessions that had no spark.checkpoint.dir (tests only).
_LOCAL_ROOTS: dict[int, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint root for a named table."""
    return os.path.join(checkpoint_root(spark), name)


# applications whose workers have the package
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the session's Python workers, whatever
    folder the driver was started in (once per application). A package that came
    as a zip file is with the workers already."""
    context, root = spark.sparkContext, Path(__file__).resolve().parent
    if context.applicationId in _SHIPPED or not root.is_dir():
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="basketry-"), "basketry_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def _hadoop_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its file system (local, HDFS, object store)."""
    fs, jpath = _hadoop_path(spark, path)
    return bool(fs.exists(jpath))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under ``path`` (empty if it is absent)."""
    fs, jpath = _hadoop_path(spark, path)
    if not fs.exists(jpath):
        return []
    return [status.getPath().getName() for status in fs.listStatus(jpath)]


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file so that it is there whole or not at all: under
    another name first, then renamed."""
    fs, jpath = _hadoop_path(spark, path)
    _, draft = _hadoop_path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(jpath):
        fs.delete(jpath, False)
    if not fs.rename(draft, jpath):
        raise OSError(f"cannot write {path}")


def read_file(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, jpath = _hadoop_path(spark, path)
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove ``path`` and everything under it, if present."""
    fs, jpath = _hadoop_path(spark, path)
    fs.delete(jpath, True)
