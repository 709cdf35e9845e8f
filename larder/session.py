"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app: str = "larder", master: str | None = None, **settings: str) -> SparkSession:
    """Session with adaptive execution on; callers add cluster settings as keywords-with-dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def replace_folder(spark: SparkSession, new: str, target: str) -> None:
    """Puts the complete folder ``new`` in the place of ``target`` by renaming; the old one is removed last."""
    jvm = spark._jvm.org.apache.hadoop.fs
    source, place, old = jvm.Path(new), jvm.Path(target), jvm.Path(f"{target.rstrip('/')}__{uuid.uuid4().hex}")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place.getParent())
    moved = files.exists(place) and files.rename(place, old)
    if not files.rename(source, place):
        if moved:
            files.rename(old, place)
        raise OSError(f"{target} could not be replaced")
    if moved:
        files.delete(old, True)


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session (a test) may go without the setting; executors on other
    machines could not read a folder of the driver.
    """
    base = spark.conf.get(CHECKPOINT_SETTING, None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_SETTING} must name a folder all executors share")
        base = tempfile.mkdtemp(prefix="larder-")
        spark.conf.set(CHECKPOINT_SETTING, base)
    return f"{base.rstrip('/')}/larder/{label}-{uuid.uuid4().hex}"
