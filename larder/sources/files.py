"""Text documents: scanning folders, finding changed ones, keeping the manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.grouping import latest_per_key

TEXT_SUFFIXES = ("md", "txt")
_ANY_CASE = "*.{" + ",".join("".join(f"[{c}{c.upper()}]" for c in s) for s in TEXT_SUFFIXES) + "}"


def text_file_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Markdown and plain-text files below ``folder``, one row per file with its whole text.

    The case of the suffix does not matter; ``other_files`` names what is left out.
    """
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", _ANY_CASE)
        .text(folder, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    )


def other_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths below ``folder`` whose type ``text_file_scan`` does not read."""
    kind = F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1))
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        .select("path").filter(~kind.isin(*TEXT_SUFFIXES))
    )


def changed_documents(
    docs: DataFrame, manifest: DataFrame, key: str = "path", text: str = "text"
) -> DataFrame:
    """Keys and hashes of documents the manifest does not hold in their present form.

    Only key and hash take part in the join; join the result back to the documents where
    the text itself is needed.
    """
    hashed = docs.select(key, F.sha2(F.col(text).cast("binary"), 256).alias("hash"))
    known = manifest.select(key, F.col("hash").alias("_known"))
    return (
        hashed.join(known, key, "left")
        .filter(~F.col("hash").eqNullSafe(F.col("_known")))
        .select(
            key,
            "hash",
            F.when(F.col("_known").isNull(), "new").otherwise("changed").alias("reason"),
        )
    )


def manifest_update(manifest: DataFrame, processed: DataFrame, key: str = "path") -> DataFrame:
    """Manifest after a run: the newest entry per key; failed documents are simply not passed."""
    columns = [key, "hash", "processed_at"]
    merged = manifest.select(*columns).unionByName(processed.select(*columns))
    return latest_per_key(merged, [key], ["processed_at"])
