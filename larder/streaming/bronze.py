"""Bronze landing: incremental parquet streams, audit columns, append-only targets."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


FILES_PER_BATCH = 10_000


def grown_schema(spark: SparkSession, path: str, known: StructType | None = None) -> StructType:
    """The known columns, then those the files below ``path`` have gained since."""
    try:
        present = spark.read.option("mergeSchema", "true").parquet(path).schema
    except AnalysisException:  # nothing has landed yet
        if known is None:
            raise
        return known
    fields = list(known.fields) if known is not None else []
    names = {f.name.lower() for f in fields}
    return StructType(fields + [f for f in present.fields if f.name.lower() not in names])


def read_feed_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    files: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """Parquet file stream and the file metadata column.

    ``path`` is a folder of files, or a table ``*.parquet``, which may also be one file. Without a schema the present columns of all
    files are taken; give ``grown_schema`` of a feed to also keep columns it gained. Files
    without a column read NULL. ``files`` is an optional glob on file names. A backlog is
    drained in batches of at most ``files_per_batch`` files, each committed on its own.
    """
    schema = grown_schema(spark, path) if schema is None else schema
    reader = (
        spark.readStream.format("parquet")
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if files is not None:
        reader = reader.option("pathGlobFilter", files)
    # A pattern may name a file or a folder; a plain path would have to be a folder.
    one_table = f"{path[:-1]}[{path[-1]}]" if path.endswith(".parquet") else path
    return reader.load(one_table).select("*", "_metadata")


def with_audit_columns(df: DataFrame) -> DataFrame:
    """Adds load time, source file and file time; both texts are empty without file metadata.

    The hidden metadata column of a file source does not show in ``df.columns``, so
    readers select it by name (see ``read_feed_stream``) and it is dropped here.
    """
    stamped = df.withColumn("_ingested_at", F.current_timestamp())
    if "_metadata" not in df.columns:
        return stamped.withColumn("_source_file", F.lit("")).withColumn("_cdc_operation", F.lit(""))
    return (
        stamped.withColumn("_source_file", F.col("_metadata.file_path"))
        .withColumn("_cdc_operation", F.col("_metadata.file_modification_time").cast("string"))
        .drop("_metadata")
    )


def append_available(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Loads every file not seen by this checkpoint once, appends, and returns when drained."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_evolved(
    spark: SparkSession, target: str, schema: StructType | None = None
) -> DataFrame:
    """All batches of a target whose schema grew: columns a batch lacks read as NULL.

    Without a schema the columns are merged from all file footers; give the present one
    where the target has many files.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(target)
    return spark.read.option("mergeSchema", "true").parquet(target)
