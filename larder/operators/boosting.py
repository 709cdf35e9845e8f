"""What boosted trees share: prepared rows, cuts from all of them, and the end of growing.

Trees only see which of a few bins an input falls into. The cuts between bins are ranks of all rows, not
of a sample, and rows that fall into the same bins with the same label are fitted as one row with a weight.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer, Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder import config
from larder.session import work_dir

INPUTS, HELD, WEIGHT = "_inputs", "_held", "_weight"
FOLD_SHARE = 5  # one key in so many is held back
BINS = 32
_MOST_BINS = 46_000  # its square is a whole number of 32 bits


def held_back(keys: Sequence[str]) -> Column:
    """Keys whose rows judge the rounds instead of growing trees."""
    return F.pmod(F.xxhash64(*keys), F.lit(FOLD_SHARE)) == 0


def bounded(rows: DataFrame, most: int, by: Sequence[str]) -> DataFrame:
    """All rows, or about ``most`` of them picked by the hash of ``by``, whatever the partitioning."""
    n = rows.count()
    if n <= most:
        return rows
    places = 1 << 30
    return rows.filter(F.pmod(F.xxhash64(F.lit("labelled"), *by), F.lit(places)) < places * most // n)


def cut_points(rows: DataFrame, inputs: Sequence[str], bins: int = BINS, buckets: int = 1024) -> list[list[float]]:
    """Per input the values that end its bins, in order, out of all rows.

    An input with no more values than bins has one for each. Else ranks are cut evenly, and a value
    counts as no more than a whole bin, so a frequent one leaves bins to the others. Values are only
    ordered inside a bucket of the range, as in ``exact_quantiles``; only the cuts reach the driver.
    """
    spark, path = rows.sparkSession, work_dir(rows.sparkSession, "values")
    one = lambda i, c: F.struct(F.lit(i).alias("input"), F.col(c).cast("double").alias("value"))
    counted = (
        rows.select(F.explode(F.array(*[one(i, c) for i, c in enumerate(inputs)])).alias("e")).select("e.*")
        .filter(F.abs("value") < math.inf)
        .groupBy("input", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    counted.write.parquet(path)
    counts = spark.read.schema(counted.schema).parquet(path)
    spread = counts.groupBy("input").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.count(F.lit(1)).alias("values"), F.sum("n").alias("all")
    )
    share = (F.col("value") - F.col("low")) / (F.col("high") - F.col("low"))
    most = F.greatest(F.floor(F.col("all") / bins), F.lit(1).cast("long"))
    placed = counts.join(F.broadcast(spread), "input").select(  # one row per input
        "input", "value", "high",
        F.when(F.col("high") > F.col("low"), F.floor(share * buckets)).otherwise(0).alias("bucket"),
        F.when(F.col("values") <= bins, F.lit(1).cast("long")).otherwise(F.least("n", most)).alias("n"),
    )
    whole, inside = Window.partitionBy("input"), Window.partitionBy("input", "bucket")
    sizes = placed.groupBy("input", "bucket").agg(F.sum("n").alias("size")).select(
        "input", "bucket",
        (F.sum("size").over(whole.orderBy("bucket")) - F.col("size")).alias("before"), F.sum("size").over(whole).alias("total"),
    )
    upto = F.col("before") + F.sum("n").over(inside.orderBy("value"))
    ranked = placed.join(sizes, ["input", "bucket"]).withColumn("upto", upto)
    bin_of = lambda rank: F.floor(rank * bins / F.col("total"))
    ends = (bin_of(F.col("upto")) > bin_of(F.col("upto") - F.col("n"))) & (F.col("value") < F.col("high"))
    found: list[list[float]] = [[] for _ in inputs]
    for r in ranked.filter(ends).select("input", "value").orderBy("input", "value").collect():
        found[r.input].append(r.value)
    return found


def _binned(cuts: Sequence[float]) -> list[float]:
    """Limits for ``Bucketizer``, whose bins hold their lower limit: a cut itself falls below its limit."""
    return [-math.inf, *(math.nextafter(c, math.inf) for c in cuts or [0.0]), math.inf]


def prepared(
    inputs: Sequence[str],
    rows: DataFrame,
    keys: Sequence[str] = (),
    flags: Sequence[str] = (),
    label: str | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """Means for missing inputs, bins, and one vector per row; the rows are written once for all fits.

    ``flags`` are further inputs that are never missing. With ``keys``, rows of held-back keys are
    marked. With ``label``, which has few values, rows that are equal in all bins, flags, label and mark
    are one row with their number as weight: the fit sees the same sums over far fewer rows.
    """
    filled, placed = [f"{c}_filled" for c in inputs], [f"{c}_bin" for c in inputs]
    imputer = Imputer(inputCols=list(inputs), outputCols=filled, strategy="mean").fit(rows)
    limits = [_binned(c) for c in cut_points(rows, inputs)]
    bins = Bucketizer(splitsArray=limits, inputCols=filled, outputCols=placed, handleInvalid="keep")
    assembler = VectorAssembler(inputCols=placed + list(flags), outputCol=INPUTS)
    made = bins.transform(imputer.transform(rows))
    if keys:
        made = made.withColumn(HELD, held_back(keys))
    if label is not None:
        same = [*placed, *flags, label, *([HELD] if keys else [])]
        made = made.groupBy(*same).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT)).sortWithinPartitions(*same)
    path = work_dir(rows.sparkSession, "prepared")
    # Bins are in order: without its metadata the vector holds numbers and not categories.
    plain = F.col(INPUTS).alias(INPUTS, metadata={})
    assembler.transform(made).drop(*filled, *placed).withColumn(INPUTS, plain).write.parquet(path)
    return PipelineModel([imputer, bins, assembler]), rows.sparkSession.read.parquet(path)


def grown(grower, rows: DataFrame, trees: config.TreeSettings):
    """The fitted ensemble, as long as the held-back keys allow.

    Where rows on both sides of the fold exist, trees grow on the others, and the rounds after the
    one with the least error on the fold are left out: with one seed the shorter ensemble is the
    beginning of the longer one. The most bins are set so high that Spark looks for them in all rows;
    no input has more than ``BINS`` values.
    """
    bins = min(max(BINS, math.isqrt(rows.count()) + 1), _MOST_BINS)
    grower = grower.setMaxBins(bins)
    if WEIGHT in rows.columns:
        grower = grower.setWeightCol(WEIGHT)
    grower = grower.setFeaturesCol(INPUTS).setMaxIter(trees.trees).setMaxDepth(trees.depth).setStepSize(trees.rate)
    grower = grower.setSeed(trees.seed).setMinInstancesPerNode(trees.least_rows)
    if HELD not in rows.columns or rows.select(HELD).distinct().count() < 2:
        return grower.fit(rows)
    train, held = rows.filter(~F.col(HELD)), rows.filter(HELD)
    model = grower.fit(train)
    regression = isinstance(grower, GBTRegressor)
    errors = model.evaluateEachIteration(held, "squared") if regression else model.evaluateEachIteration(held)
    best = errors.index(min(errors)) + 1
    return model if best == len(errors) else grower.setMaxIter(best).fit(train)
