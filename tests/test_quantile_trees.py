from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from larder import config
from larder.operators import demand
from larder.operators.quantile_trees import LEAST_FOLD, quantile_predict, quantile_train

SCHEMA = "werks string, unified_sku_id string, a double, b double, y double"
KEYS = ["werks", "unified_sku_id"]


def noisy(seed, n):
    """The spread of y grows with a; its middle depends on b."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        a, b = rng.uniform(0, 10), rng.choice([0.0, 1.0])
        rows.append((str(seed), f"S{i}", a, b, 20 * b + rng.gauss(0, 1) * (0.5 + a)))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    rows = spark.createDataFrame(noisy(1, 3000), SCHEMA)
    return quantile_train(rows, ["a", "b"], "y", KEYS, trees=config.TreeSettings(trees=5, depth=3, rate=0.5, least_rows=20))


def test_unseen_rows_are_covered_and_the_loss_is_below_a_constant(spark, fitted):
    unseen = spark.createDataFrame(noisy(2, 2000), SCHEMA)
    found = quantile_predict(fitted, unseen, ["a", "b"], "q_{}")
    flat = unseen.agg(*[F.percentile("y", s).alias(n) for n, s in config.QUANTILES.items()]).first()
    for n in config.QUANTILES:
        found = found.withColumn(f"flat_{n}", F.lit(flat[n]))
    ours = {r.quantile: r for r in demand.quantile_scores(found, "y", {n: f"q_{n}" for n in config.QUANTILES}).collect()}
    theirs = {r.quantile: r for r in demand.quantile_scores(found, "y", {n: f"flat_{n}" for n in config.QUANTILES}).collect()}
    for n, share in config.QUANTILES.items():
        assert ours[n].n_rows == 2000
        assert ours[n].coverage == pytest.approx(share, abs=0.03)
        assert ours[n].pinball_loss < 0.8 * theirs[n].pinball_loss
    narrow, wide = (found.filter(f"a {t}").agg(F.avg(F.col("q_p90") - F.col("q_p10"))).first()[0] for t in ("< 2", "> 8"))
    assert wide > 2 * narrow


def test_model_is_a_table_and_adds_up_leaf_by_leaf(spark, fitted, tmp_path):
    fitted.write.parquet(str(tmp_path / "m"))
    model = spark.read.parquet(str(tmp_path / "m"))
    leaves = model.collect()
    rows = spark.createDataFrame(noisy(3, 40), SCHEMA)
    for r in quantile_predict(model, rows, ["a", "b"]).collect():
        for n in config.QUANTILES:
            want = sum(
                leaf.value for leaf in leaves
                if leaf.quantile == n and all(lo < (r.a, r.b)[i] <= hi for i, lo, hi in zip(leaf.inputs, leaf.lows, leaf.highs))
            )
            assert r[n] == pytest.approx(want)


def test_missing_inputs_few_rows_and_no_rows(spark, fitted):
    row = spark.createDataFrame([("1", "S", None, 1.0, 2.0)], SCHEMA)
    assert [quantile_predict(fitted, row, ["a", "b"]).first()[n] for n in config.QUANTILES] == [None] * 3
    few = spark.createDataFrame(noisy(4, LEAST_FOLD), SCHEMA)
    model = quantile_train(few, ["a", "b"], "y", KEYS)
    assert sorted((r.quantile, r.round) for r in model.collect()) == [("p10", 0), ("p50", 0), ("p90", 0)]
    empty = quantile_train(few.limit(0), ["a", "b"], "y", KEYS)
    assert empty.count() == 0
    assert quantile_predict(empty, few, ["a", "b"]).filter("p50 IS NOT NULL").count() == 0


def test_forecast_takes_trees_and_else_the_category(spark, rows):
    corrected = rows(
        "werks string, unified_sku_id string, corrected_7d double, corrected_14d double, corrected_28d double, promo_lift double, weather_lift double",
        ("1", "A", 10.0, 20.0, 40.0, 1.0, 1.0), ("1", "B", 10.0, 20.0, 40.0, None, 1.0),
    )
    categories = rows("werks string, unified_sku_id string, category string", ("1", "A", "c"), ("1", "B", "c"))
    known = rows("category string, residual_p10 double, residual_p50 double, residual_p90 double", ("c", -1.0, 0.0, 1.0), ("*", -9.0, 0.0, 9.0))
    model = spark.createDataFrame(
        [(n, 0, [], [], [], v) for n, v in (("p10", -5.0), ("p50", 1.0), ("p90", 7.0))],
        "quantile string, round int, inputs array<int>, lows array<double>, highs array<double>, value double",
    )
    got = {r.unified_sku_id: (r.p10, r.p50, r.p90) for r in demand.quantile_forecast(corrected, categories, known, model).collect()}
    assert got == {"A": (5.0, 11.0, 17.0), "B": (9.0, 10.0, 11.0)}
    plain = {r.unified_sku_id: (r.p10, r.p50, r.p90) for r in demand.quantile_forecast(corrected, categories, known).collect()}
    assert plain == {"A": (9.0, 10.0, 11.0), "B": (9.0, 10.0, 11.0)}
