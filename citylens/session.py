"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job relies on.  Anything already set by the cluster wins.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "citylens") -> SparkSession:
    """Create (or reuse) a session with the settings the library assumes.

    ``master``/``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them ``None`` so the submit-time configuration applies.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting points at shared storage and is only read; a
    cluster session without it is refused, because executors could not see
    each other's files.  Only a ``local`` master (tests, laptops) gets a
    fresh local folder of its own.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="citylens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def _file_system(spark: SparkSession, path: str):
    """(file system, path) of the store that ``path`` names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file exists in the file system that its path names."""
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder or file to a name that does not exist yet; parents are made."""
    fs, a = _file_system(spark, source)
    _, b = _file_system(spark, target)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"cannot rename {source} to {target}")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder or file with all it holds, if it exists."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def list_names(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    fs, target = _file_system(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(target) or []]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete as soon as it is visible (written beside, then renamed)."""
    fs, target = _file_system(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    move_folder(spark, target.toString(), path)


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def use_utc(spark: SparkSession) -> None:
    """Data products are defined on UTC epochs; pin the session clock."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


