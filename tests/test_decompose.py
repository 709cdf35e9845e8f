from __future__ import annotations

import math
import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder import config
from larder.operators import decompose

SCHEMA = "werks string, unified_sku_id string, ds date, y double, note string"
S = config.DecompositionSettings()


def dense(days, values, settings=S):
    """Components by a dense solver: (trend, weekly, yearly) per day."""
    first, span = min(days), max((max(days) - min(days)).days, 1)
    size = max(max(abs(v) for v in values), 1e-9)
    blocks = []
    for day in days:
        d, t = float((day - date(1970, 1, 1)).days), (day - first).days / span
        bends = [settings.bent_share * (i + 1) / (settings.bends + 1) for i in range(settings.bends)]
        wave = lambda period, order: [f(d * 2 * math.pi * k / period) for k in range(1, order + 1) for f in (math.sin, math.cos)]
        blocks.append(([1.0, t, *[max(t - b, 0.0) for b in bends]], wave(7.0, settings.week_order), wave(365.25, settings.year_order)))
    x = np.array([[v for part in row for v in part] for row in blocks])
    w = np.linalg.solve(x.T @ x + np.diag(decompose.penalties(settings)), x.T @ (np.array(values) / size))
    ends = np.cumsum([0, *[len(part) for part in blocks[0]]])
    return np.stack([x[:, a:b] @ w[a:b] * size for a, b in zip(ends, ends[1:])], axis=1)


def components(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    return decompose.changing_components(frame).collect()


def test_agrees_with_a_dense_solver(spark):
    rng, rows = random.Random(5), []
    for sku, n, step in (("A", 400, 1), ("B", 90, 3), ("C", 14, 1), ("D", 1, 1), ("E", 2, 40)):
        day = date(2023, 1, 1)
        for i in range(n):
            day += timedelta(days=rng.choice([1, step]))
            rows.append(("1", sku, day, rng.uniform(0, 50) + i / 10, f"{sku}{i}"))
    rows += [("2", "Z", date(2023, 1, 1) + timedelta(days=i), 0.0, None) for i in range(20)]
    found = {}
    for r in components(spark, rows):
        found.setdefault((r.werks, r.unified_sku_id), []).append(r)
    assert sum(map(len, found.values())) == len(rows)
    for key, got in found.items():
        got.sort(key=lambda r: r.ds)
        want = dense([r.ds for r in got], [r.y for r in got])
        assert np.array([[r.trend, r.weekly, r.yearly] for r in got]) == pytest.approx(want, abs=1e-5)
        assert [r.note for r in got] == sorted((r.note for r in got), key=lambda n: int((n or "x0")[1:])) or key[0] == "2"


@pytest.mark.parametrize("n, mean_error", [(730, 2.0), (1095, 0.8)])
def test_a_kink_and_a_yearly_wave_are_found(spark, n, mean_error):
    first, kink = date(2022, 1, 1), n // 2
    line = lambda i: 100 + 0.05 * i if i < kink else 100 + 0.05 * kink - 0.15 * (i - kink)
    year = lambda d: 20 * math.sin(2 * math.pi * (d - date(1970, 1, 1)).days / 365.25)
    week = lambda d: 6.0 if d.weekday() == 5 else -1.0
    days = [first + timedelta(days=i) for i in range(n)]
    rows = [("1", "S", d, line(i) + year(d) + week(d), "") for i, d in enumerate(days)]
    found = sorted(components(spark, rows), key=lambda r: r.ds)
    errors = np.abs([[r.trend - line(i), r.weekly - week(r.ds), r.yearly - year(r.ds)] for i, r in enumerate(found)])
    assert (errors.mean(axis=0) < [mean_error, 0.1, mean_error]).all()
    slope = lambda a, b: (found[b].trend - found[a].trend) / (b - a)
    assert slope(50, kink - 50) == pytest.approx(0.05, abs=0.02)
    assert slope(kink + 50, n - 50) == pytest.approx(-0.15, abs=0.02)


def test_nulls_extra_columns_and_empty_table(spark):
    rows = [("1", "S", date(2024, 1, i), float(i), None) for i in range(1, 20)] + [("1", "S", date(2024, 1, 25), None, "x"), ("1", "N", date(2024, 1, 1), None, "y")]
    found = components(spark, rows)
    assert len(found) == 19 and all(math.isfinite(r.trend + r.weekly + r.yearly) for r in found)
    assert set(found[0].asDict()) == {"werks", "unified_sku_id", "ds", "y", "note", "trend", "weekly", "yearly"}
    assert components(spark, []) == []


def test_one_shuffle(spark):
    frame = spark.createDataFrame([("1", "S", date(2024, 1, 1), 1.0, "")], SCHEMA)
    plan = decompose.changing_components(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan
