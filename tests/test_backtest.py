from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from larder import config
from larder.operators import backtest, boosting, demand, phantom
from larder.operators.backtest import Fold, folds

D = dt.date


def test_folds_by_hand():
    assert folds(D(2024, 1, 1), D(2024, 1, 30), 2, 10) == [
        Fold(0, D(2024, 1, 11), D(2024, 1, 20)), Fold(1, D(2024, 1, 21), D(2024, 1, 30)),
    ]
    assert [f.number for f in folds(D(2024, 1, 1), D(2024, 1, 30), 5, 10)] == [3, 4]
    assert Fold(0, D(2024, 1, 11), D(2024, 1, 20), 3).known_until == D(2024, 1, 7)
    assert folds(D(2024, 1, 1), D(2024, 1, 30), 5, 10, gap=15) == [Fold(4, D(2024, 1, 21), D(2024, 1, 30), 15)]


def test_no_fold_sees_its_future(spark):
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    rows = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "day date, v int")
    seen = {}

    def fit(known):
        newest = known.agg(F.max("day")).first()[0]
        seen[newest] = known.count()
        return newest

    origins = folds(days[0], days[-1], 3, 10, gap=2)
    scored = backtest.rolling_origin(rows, "day", origins, fit, lambda newest, ahead: ahead.withColumn("newest", F.lit(newest))).collect()
    assert sorted(r.day for r in scored) == days[10:]
    assert all(r.newest == r.known_until < r.day - dt.timedelta(days=2) for r in scored)
    assert seen == {f.known_until: (f.known_until - days[0]).days + 1 for f in origins}
    with pytest.raises(ValueError):
        backtest.rolling_origin(rows.limit(0), "day", origins, fit, lambda m, a: a)


def test_scores_of_past_days_do_not_depend_on_later_ones(spark):
    rng = random.Random(4)
    columns = config.PHANTOM_FEATURES
    rows = []
    for i in range(30):
        for day in range(20):
            x = [float(rng.randint(0, 30)) for _ in columns]
            rows.append(("1", f"S{i}", D(2024, 1, 1) + dt.timedelta(days=day), *x, int(x[1] > 15)))
    schema = "werks string, unified_sku_id string, label_date date, " + ", ".join(f"{c} double" for c in columns) + ", is_phantom int"
    training = spark.createDataFrame(rows, schema)
    origins = folds(D(2024, 1, 1), D(2024, 1, 20), 2, 5)
    size = config.TreeSettings(trees=3, depth=2, rate=0.3)
    whole = {(r.unified_sku_id, r.label_date): r.phantom_score for r in phantom.backtest_scores(training, origins, size).collect()}
    # Later labels turned around: the scores of the first fold stay as they were.
    late = F.col("label_date") >= F.lit(origins[1].first)
    turned = training.withColumn("is_phantom", F.when(late, 1 - F.col("is_phantom")).otherwise(F.col("is_phantom")))
    other = {(r.unified_sku_id, r.label_date): r.phantom_score for r in phantom.backtest_scores(turned, origins, size).collect()}
    assert len(whole) == 300
    assert all(other[k] == v for k, v in whole.items() if k[1] <= origins[0].last)
    right = sum((v > 0.5) == (row[4] > 15) for row in rows for k, v in [((row[1], row[2]), whole.get((row[1], row[2])))] if v is not None)
    assert right > 290


def test_hold_out_measures(rows):
    scored = rows(
        "werks string, unified_sku_id string, fold int, forecast_7d double, forecast_14d double, forecast_28d double, "
        "demand_7d double, demand_14d double, demand_28d double",
        ("1", "A", 0, 10.0, 20.0, 40.0, 8.0, 20.0, None), ("1", "B", 0, 5.0, 9.0, 20.0, 6.0, 10.0, 20.0),
    )
    got = {r.horizon_days: (r.n_rows, r.mae, r.mean_demand, r.passes) for r in demand.hold_out_error(scored).collect()}
    assert got == {7: (2, 1.5, 7.0, False), 14: (2, 0.5, 15.0, True), 28: (1, 0.0, 20.0, True)}


@pytest.fixture(scope="module")
def noisy(spark):
    rng, rows = random.Random(6), []
    for i in range(1500):
        a, b = rng.uniform(0, 10), rng.uniform(0, 10)
        rows.append(("1", f"S{i}", a if rng.random() > 0.1 else None, b, (a > 5) * 4 + b + rng.gauss(0, 2)))
    return spark.createDataFrame(rows, "werks string, unified_sku_id string, a double, b double, y double")


def test_growing_ends_on_the_fold_and_errs_no_more_than_twenty_rounds(spark, noisy):
    keys = ["werks", "unified_sku_id"]
    _, ready = boosting.prepared(["a", "b"], noisy, keys)
    held = ready.filter(boosting.HELD)
    assert 200 < held.count() < 400
    size = config.TreeSettings(trees=25, depth=4, rate=0.3)
    stopped = boosting.grown(GBTRegressor(labelCol="y"), ready, size)
    fixed = GBTRegressor(featuresCol=boosting.INPUTS, labelCol="y", maxIter=20, maxDepth=4, stepSize=0.3, seed=7).fit(
        ready.filter(~F.col(boosting.HELD))
    )
    error = lambda m: m.transform(held).agg(F.avg(F.pow(F.col("prediction") - F.col("y"), 2))).first()[0]
    assert stopped.getNumTrees < 20
    assert error(stopped) <= error(fixed)
    assert stopped.treeWeights == fixed.treeWeights[: stopped.getNumTrees]
    assert [t.toDebugString.split("\n", 1)[1] for t in stopped.trees] == [
        t.toDebugString.split("\n", 1)[1] for t in fixed.trees[: stopped.getNumTrees]
    ]


def test_labelled_rows_are_bounded_by_the_hash_of_their_key(noisy):
    some = boosting.bounded(noisy, 500, ["unified_sku_id"])
    assert 400 < some.count() < 600
    again = boosting.bounded(noisy.repartition(7), 500, ["unified_sku_id"])
    ids = lambda df: sorted(r[0] for r in df.select("unified_sku_id").collect())
    assert ids(some) == ids(again)
    assert boosting.bounded(noisy, 1500, ["unified_sku_id"]).count() == 1500


def many(spark, n=210_000):
    """More rows than models were once fitted on."""
    rows = spark.range(n).withColumns({"werks": F.lit("1"), "unified_sku_id": F.concat(F.lit("S"), F.col("id") % 70)})
    return rows.withColumn("ds", F.date_add(F.lit(D(2000, 1, 1)), F.expr("CAST(id DIV 70 AS int)")))


def test_all_labelled_rows_are_fitted_on(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(phantom, "grown", lambda grower, rows, trees: seen.append(rows))
    columns = {c: (F.col("id") % (i + 2)).cast("double") for i, c in enumerate(config.PHANTOM_FEATURES)}
    phantom.phantom_train(many(spark).withColumns({**columns, "is_phantom": (F.col("id") % 3 == 0).cast("int")}))
    assert seen[0].agg(F.sum(boosting.WEIGHT)).first()[0] == 210_000
    assert seen[0].count() < 10_500


def test_demand_is_fitted_on_all_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(demand, "_fit", lambda steps, rows, *rest: seen.append(rows.count()))
    columns = {c: (F.col("id") % (i + 2)).cast("double") for i, c in enumerate(config.DEMAND_FEATURES)}
    demand.m1_train(many(spark).withColumns({**columns, "demand_7d": F.col("id").cast("double")}), horizons=(7,))
    assert seen == [210_000]


def test_cuts_come_from_all_rows(spark):
    rng = random.Random(8)
    few = [rng.choice([0.0, 0.0, 0.0, 3.0, 5.0]) for _ in range(3000)]
    often = [0.0 if rng.random() < 0.9 else rng.uniform(1, 2) for _ in range(3000)]
    rows = spark.createDataFrame([*zip(few, often), (None, None)], "few double, often double")
    cuts = boosting.cut_points(rows, ["few", "often"], bins=8)
    assert cuts[0] == [0.0, 3.0]
    counts = {v: min(often.count(v), 3000 // 8) for v in set(often)}
    want, upto, total = [], 0, sum(counts.values())
    for v in sorted(counts):
        before, upto = upto, upto + counts[v]
        if before * 8 // total < upto * 8 // total and v < max(counts):
            want.append(v)
    assert cuts[1] == want and want[0] == 0.0 and len(want) > 3
    assert boosting.cut_points(rows.repartition(5), ["few", "often"], bins=8) == cuts


def test_equal_rows_count_by_their_weight(spark):
    rng, keys = random.Random(9), ["werks", "unified_sku_id"]
    data = [("1", f"S{i}", float(rng.randint(0, 9)), rng.choice([None, 0.0, rng.uniform(0, 9)])) for i in range(1200)]
    data = [(*r, int(r[2] > 4 and not r[3])) for r in data]
    rows = spark.createDataFrame(data, "werks string, unified_sku_id string, a double, b double, y int")
    size = config.TreeSettings(trees=4, depth=3, rate=0.3)
    made = {}
    for label in (None, "y"):
        steps, ready = boosting.prepared(["a", "b"], rows, keys, label=label)
        model = boosting.grown(GBTClassifier(labelCol="y"), ready, size)
        scored = PipelineModel([*steps.stages, model]).transform(rows)
        made[label] = ready.count(), {r.unified_sku_id: r.rawPrediction[1] for r in scored.collect()}
    assert made["y"][0] < made[None][0] == 1200
    assert made["y"][1] == pytest.approx(made[None][1], abs=1e-9)
