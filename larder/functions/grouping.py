"""Latest row per key, numbering inside large groups and exact quantiles.

All three stay spread over the cluster when one key holds a large share of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.session import work_dir


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """Newest row of every key.

    Remaining columns break ties, so the pick does not depend on the partitioning. The
    rank filter lets Spark cut each map task down to one row per key before the shuffle.
    """
    ties = [c for c in df.columns if c not in keys and c not in newest_first]
    order = [F.col(c).desc_nulls_last() for c in newest_first]
    order += [F.col(c).asc_nulls_first() for c in ties]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def numbered_within(
    df: DataFrame, group: str, major: str, minor: Sequence[str], name: str
) -> DataFrame:
    """Numbers rows 1..n inside ``group``, ordered by ``major`` and then ``minor``.

    Rows are only ever sorted inside (group, major). The start of each ``major`` comes from
    a running sum over one count per (group, major), so a group with a third of all rows
    still runs on many tasks. ``group`` and ``major`` must not be NULL.
    """
    sizes = df.groupBy(group, major).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(group).orderBy(major).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        group, major, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy(group, major).orderBy(*minor)
    return (
        df.withColumn("_place", F.row_number().over(inside))
        .join(starts, [group, major], "inner")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_start", "_place")
    )


def exact_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    quantiles: dict[str, float],
    buckets: int = 1024,
) -> DataFrame:
    """Interpolated quantiles of ``value`` per group as one column per name.

    The built-in ``percentile`` keeps every distinct value of a group in one buffer. Here
    equal values are counted first and written, the wanted ranks are located on ``buckets``
    equal parts of the range of the group, and values are only ordered inside a bucket. A
    group with a third of all rows is spread over as many tasks as it has buckets.
    """
    spark, path = df.sparkSession, work_dir(df.sparkSession, "counts")
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*groups, F.col(value).cast("double").alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    counted.write.parquet(path)
    counts = spark.read.schema(counted.schema).parquet(path)
    spread = counts.groupBy(*groups).agg(F.min("_value").alias("_low"), F.max("_value").alias("_high"))
    share = (F.col("_value") - F.col("_low")) / (F.col("_high") - F.col("_low"))
    counts = (
        counts.join(spread, list(groups))
        .withColumn("_bucket", F.when(F.col("_high") > F.col("_low"), F.floor(share * buckets)).otherwise(0))
        .drop("_low", "_high")
    )
    in_bucket = Window.partitionBy(*groups, "_bucket")
    per_value = counts.withColumn("_upto", F.sum("_n").over(in_bucket.orderBy("_value")))
    whole = Window.partitionBy(*groups)
    ordered = whole.orderBy("_bucket")
    per_bucket = (
        counts.groupBy(*groups, "_bucket")
        .agg(F.sum("_n").alias("_size"))
        .withColumn("_before", F.sum("_size").over(ordered) - F.col("_size"))
        .withColumn("_total", F.sum("_size").over(whole))
    )
    ranks = []
    for name, share in quantiles.items():
        place = (F.col("_total") - 1) * F.lit(float(share))
        for side, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
            ranks.append(
                F.struct(
                    F.lit(name).alias("name"),
                    F.lit(side).alias("side"),
                    (rank - F.col("_before")).alias("offset"),
                    (place - F.floor(place)).alias("share"),
                )
            )
    hits = (
        per_bucket.select(*groups, "_bucket", "_size", F.explode(F.array(*ranks)).alias("_want"))
        .filter((F.col("_want.offset") >= 0) & (F.col("_want.offset") < F.col("_size")))
        .select(*groups, "_bucket", "_want")
    )
    found = per_value.join(hits, [*groups, "_bucket"], "inner").filter(
        (F.col("_want.offset") < F.col("_upto"))
        & (F.col("_want.offset") >= F.col("_upto") - F.col("_n"))
    )

    def pick(name: str, column: str, side: str = "low") -> Column:
        is_it = (F.col("_want.name") == name) & (F.col("_want.side") == side)
        return F.max(F.when(is_it, F.col(column)))

    return found.groupBy(*groups).agg(
        *[
            (
                pick(n, "_value")
                + (pick(n, "_value", "high") - pick(n, "_value")) * pick(n, "_want.share")
            ).alias(n)
            for n in quantiles
        ]
    )
