"""Publishing tables: replace, replace with declared keys, append."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.session import remove_folder, replace_folder, work_dir


class DuplicateKeyError(ValueError):
    """A feature table holds more than one row for a primary key."""


def _write(df: DataFrame, target: str, mode: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode).partitionBy(*partition_by) if partition_by else df.write.mode(mode)
    if "/" in target:
        writer.parquet(target)
    else:
        writer.saveAsTable(target)


def _swap_in(df: DataFrame, target: str, partition_by: Sequence[str] = (), beside: str | None = None) -> None:
    """Writes a folder beside ``beside`` (or the target), then puts it in the place of the target."""
    new = f"{(beside or target).rstrip('/')}__{uuid.uuid4().hex}"
    try:
        _write(df, new, "errorifexists", partition_by)
        replace_folder(df.sparkSession, new, target)
    except Exception:
        remove_folder(df.sparkSession, new)
        raise


def _clock(clock: Column | None) -> Column:
    return F.current_timestamp() if clock is None else clock


def publish_overwrite(df: DataFrame, target: str, clock: Column | None = None) -> None:
    """Replaces a table (a name, or a folder when it holds a slash) and stamps its rows.

    A folder is written beside its target and takes its place when it is complete, so a job that is
    lost while writing leaves the old rows; the new rows may even be computed from them.
    """
    stamped = df.withColumn("_computed_at", _clock(clock))
    if "/" not in target:
        _write(stamped, target, "overwrite")
        return
    _swap_in(stamped, target)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or hold a NULL."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter((F.col("n_rows") > 1) | missing)
    )


def publish_features(
    df: DataFrame, target: str, keys: Sequence[str], clock: Column | None = None
) -> None:
    """Replaces a feature table after checking its primary key.

    The rows go to the shared working folder first: the check and the publication read the
    written copy, so the upstream plan runs once and bad rows never reach the target.
    """
    spark = df.sparkSession
    staged_at = work_dir(spark, "features")
    df.write.parquet(staged_at)
    staged = spark.read.schema(df.schema).parquet(staged_at)
    doubled = duplicate_keys(staged, keys).limit(5).collect()
    if doubled:
        raise DuplicateKeyError(f"{target}: key {tuple(keys)} is not unique, e.g. {doubled}")
    publish_overwrite(staged, target, clock)
    remove_folder(spark, staged_at)


def publish_append(
    df: DataFrame,
    target: str,
    stamp: str = "_created_at",
    clock: Column | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Adds rows with a load time; existing rows are never touched."""
    _write(df.withColumn(stamp, _clock(clock)), target, "append", partition_by)


RUN = "_run_id"


def run_id_of(rows: DataFrame, ignore: Sequence[str] = ()) -> str:
    """Name of a run by what it writes: equal rows, in any order, have the same name."""
    columns = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in sorted(rows.columns) if c not in ignore]
    first, second = (F.xxhash64(F.lit(salt), *columns).cast("decimal(38,0)") for salt in ("a", "b"))
    n, a, b = rows.agg(F.count(F.lit(1)), F.sum(first), F.sum(second)).first()
    return "-".join([str(n), *(f"{int(x or 0) % (1 << 64):016x}" for x in (a, b))])


def publish_run(
    df: DataFrame,
    target: str,
    run_id: str | None = None,
    stamp: str = "_created_at",
    clock: Column | None = None,
    partition_by: Sequence[str] = (),
    ignore: Sequence[str] = (),
) -> str:
    """Adds the rows of one run to a log in folders; a repeated run takes the place of its first try.

    The run is named, or named by its rows without the columns in ``ignore`` (times of the run). Rows
    are staged first, so the name and the log see the same ones. Rows of other runs are not touched. The
    log is read as one table with the column ``_run_id``.
    """
    spark = df.sparkSession
    staged_at = work_dir(spark, "run")
    df.write.parquet(staged_at)
    staged = spark.read.schema(df.schema).parquet(staged_at)
    name = run_id or run_id_of(staged, ignore)
    place = f"{target.rstrip('/')}/{RUN}={quote(name, safe='')}"
    _swap_in(staged.withColumn(stamp, _clock(clock)), place, partition_by, beside=target)
    remove_folder(spark, staged_at)
    return name
