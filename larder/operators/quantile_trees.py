"""Boosted trees for quantiles: each round grows a tree on the side of the present estimate a value
falls on, and gives every leaf the exact quantile of what is left there.

A model is a table of leaves: quantile, round, the bounds of the leaf and what it adds. It is saved
like any table, and applied with array expressions. A fold of keys is held back: it ends the rounds
of a quantile when its loss stops falling, and shifts the estimate to the quantile the fold shows.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import config
from larder.functions.grouping import exact_quantiles
from larder.operators.explain import leaves_of
from larder.session import work_dir

MODEL = "quantile string, round int, inputs array<int>, lows array<double>, highs array<double>, value double"
FOLD_SHARE = 5  # one key in so many is held back
LEAST_FOLD = 30  # smaller folds say nothing: then there are no rounds and no shift


def pinball_loss(value: Column, estimate: Column, share: float) -> Column:
    """Loss of an estimate of the quantile ``share``."""
    return F.greatest(share * (value - estimate), (share - 1) * (value - estimate))


def _meets(leaf: tuple, x: Sequence[Column]) -> Column:
    """Whether a row falls into the leaf (inputs, lows, highs)."""
    tests = [(x[i] > F.lit(low)) & (x[i] <= F.lit(high)) for i, low, high in zip(*leaf[:3])]
    out = F.lit(True)
    for test in tests:
        out = out & test
    return out


def _estimate(leaves: Sequence[tuple], x: Sequence[Column]) -> Column:
    """Sum over rounds of the value of the leaf a row falls into; leaves are (inputs, lows, highs, value, round)."""
    rounds: dict[int, list[tuple]] = {}
    for leaf in leaves:
        rounds.setdefault(leaf[4], []).append(leaf)
    total = F.lit(0.0)
    for found in rounds.values():
        step = F.lit(0.0)
        for leaf in found:
            step = F.when(_meets(leaf, x), F.lit(leaf[3])).otherwise(step)
        total = total + step
    return total


def quantile_train(
    rows: DataFrame,
    inputs: Sequence[str],
    target: str,
    keys: Sequence[str],
    quantiles: dict[str, float] = config.QUANTILES,
    trees: config.TreeSettings = config.QUANTILE_TREES,
) -> DataFrame:
    """The model table. Rows with a missing input or target are left out; without rows it is empty.

    Trees of all quantiles grow side by side. Only leaf bounds and values pass through the driver,
    whose number depends on ``trees`` alone; each round is a pass over the written rows.
    """
    spark, names = rows.sparkSession, list(quantiles)
    path = work_dir(spark, "quantile-rows")
    held = F.pmod(F.xxhash64(*keys), F.lit(FOLD_SHARE)) == 0
    doubles = [F.col(c).cast("double").alias(c) for c in (*inputs, target)]
    given = rows.select(*doubles, held.alias("_held")).dropna()
    assembler = VectorAssembler(inputCols=list(inputs), outputCol="_inputs")
    assembler.transform(given).write.parquet(path)
    given = spark.read.parquet(path)
    sizes = dict(given.groupBy("_held").count().collect())
    if not sizes.get(False):
        return spark.createDataFrame([], MODEL)
    x, y, train, fold = [F.col(c) for c in inputs], F.col(target), given.filter(~F.col("_held")), given.filter("_held")
    first = exact_quantiles(train.withColumn("_all", F.lit(0)), ["_all"], target, quantiles).first()
    model = {n: [((), (), (), first[n], 0)] for n in names}
    if sizes.get(True, 0) < LEAST_FOLD:
        return _table(spark, model)

    def losses() -> dict[str, float]:
        return fold.agg(*[F.avg(pinball_loss(y, _estimate(model[n], x), s)).alias(n) for n, s in quantiles.items()]).first().asDict()

    def grow(name: str) -> list[tuple]:
        side = F.when(y < _estimate(model[name], x), quantiles[name] - 1.0).otherwise(quantiles[name])
        tree = DecisionTreeRegressor(
            featuresCol="_inputs", labelCol="_side", maxDepth=trees.depth, minInstancesPerNode=trees.least_rows, seed=trees.seed
        ).fit(train.select("_inputs", side.alias("_side")))
        return [(leaf.inputs, leaf.lows, leaf.highs) for leaf in leaves_of(_Single(tree))]

    best, active = losses(), list(names)
    rounds = {n: 0 for n in names}
    with ThreadPoolExecutor(len(names)) as pool:
        for number in range(1, trees.trees + 1):
            task = inheritable_thread_target(spark)(grow)
            grown = dict(zip(active, pool.map(task, active)))
            leaf_of = {
                n: F.coalesce(*[F.when(_meets(leaf, x), F.lit(i)) for i, leaf in enumerate(found)]) for n, found in grown.items()
            }
            left = train.select(F.explode(F.array(*[
                F.struct(F.lit(n).alias("n"), leaf_of[n].alias("leaf"), (y - _estimate(model[n], x)).alias("rest")) for n in active
            ])).alias("e")).select("e.*")
            found = {(r.n, r.leaf): r for r in exact_quantiles(left, ["n", "leaf"], "rest", quantiles).collect()}
            for n in active:
                model[n] += [
                    (*leaf, trees.rate * found[n, i][n], number) for i, leaf in enumerate(grown[n]) if (n, i) in found
                ]
            now = losses()
            for n in list(active):
                if now[n] < best[n]:
                    best[n], rounds[n] = now[n], number
                elif number - rounds[n] >= trees.patience:
                    active.remove(n)
            if not active:
                break
    model = {n: [leaf for leaf in leaves if leaf[4] <= rounds[n]] for n, leaves in model.items()}
    left = fold.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("n"), (y - _estimate(model[n], x)).alias("rest")) for n in names
    ])).alias("e")).select("e.*")
    for r in exact_quantiles(left, ["n"], "rest", quantiles).collect():
        model[r.n].append(((), (), (), r[r.n], -1))
    return _table(spark, model)


class _Single:
    """One tree as an ensemble."""

    def __init__(self, tree):
        self.trees, self.treeWeights = [tree], [1.0]


def _table(spark, model: dict[str, list[tuple]]) -> DataFrame:
    rows = [
        (name, number, list(inputs), list(lows), list(highs), float(value))
        for name, leaves in model.items() for inputs, lows, highs, value, number in leaves
    ]
    return spark.createDataFrame(rows, MODEL)


def quantile_predict(
    model: DataFrame, rows: DataFrame, inputs: Sequence[str], name: str = "{}", quantiles: Sequence[str] = tuple(config.QUANTILES)
) -> DataFrame:
    """Adds the estimate of every quantile; NULL with an empty model or a missing input.

    The model enters as a scalar subquery, so nothing passes through the driver here.
    """
    table = model.groupBy("quantile").agg(
        F.collect_list(F.struct("inputs", "lows", "highs", "value")).alias("leaves")
    ).agg(F.map_from_entries(F.collect_list(F.struct("quantile", "leaves"))).alias("m")).scalar()
    x = F.array(*[F.col(c).cast("double") for c in inputs])

    def inside(row: Column, leaf: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(leaf["inputs"]) - 1)
        tests = lambda k: (row[leaf["inputs"][k]] > leaf["lows"][k]) & (row[leaf["inputs"][k]] <= leaf["highs"][k])
        return (F.size(leaf["inputs"]) == 0) | F.forall(F.when(F.size(leaf["inputs"]) > 0, places), tests)

    def estimate(n: str) -> Column:
        leaves = F.try_element_at("_trees", F.lit(n))
        add = lambda row: lambda total, leaf: total + F.when(inside(row, leaf), leaf["value"]).otherwise(0.0)
        found = F.transform(F.array(x), lambda row: F.aggregate(leaves, F.lit(0.0), add(row)))[0]
        whole = F.forall(x, lambda v: v.isNotNull())
        return F.when(whole, found)

    return rows.withColumn("_trees", table).withColumns({name.format(n): estimate(n) for n in quantiles}).drop("_trees")
