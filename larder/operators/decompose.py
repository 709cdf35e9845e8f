"""Additive split of daily series: a trend that may bend, a weekly and a yearly wave.

Each series is one ridge regression. Its days are gathered once (a row per day, so the calendar
bounds them), the normal equations are summed over them and solved by elimination, all in array
expressions: one shuffle, no Python. Bends of the trend and waves are held small by a penalty, so
short series get a straight line and little else.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import config

SETTINGS = config.DecompositionSettings()
YEAR, WEEK = 365.25, 7.0


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def basis(day: Column, share: Column, settings: config.DecompositionSettings = SETTINGS) -> list[list[Column]]:
    """Columns of trend, week and year for a day number and its share of the span of the series."""
    one = F.lit(1.0)
    bends = [settings.bent_share * (i + 1) / (settings.bends + 1) for i in range(settings.bends)]
    trend = [one, share, *[F.greatest(share - b, F.lit(0.0)) for b in bends]]

    def wave(period: float, order: int) -> list[Column]:
        turns = [day * (2 * math.pi * k / period) for k in range(1, order + 1)]
        return [f(t) for t in turns for f in (F.sin, F.cos)]

    return [trend, wave(WEEK, settings.week_order), wave(YEAR, settings.year_order)]


def penalties(settings: config.DecompositionSettings = SETTINGS) -> list[float]:
    """Weight of the square of each coefficient, in the order of ``basis``."""
    waves = 2 * (settings.week_order + settings.year_order)
    return [settings.line_penalty] * 2 + [settings.bend_penalty] * settings.bends + [settings.wave_penalty] * waves


def normal_equations(xs: Column, ys: Column, penalty: Sequence[float]) -> Column:
    """Rows of the symmetric system with its right side as last column, from arrays of inputs and values."""
    p = len(penalty)
    places, ridge = F.sequence(F.lit(0), F.lit(p - 1)), F.array(*map(F.lit, penalty))
    rows = lambda: F.sequence(F.lit(0), F.size(ys) - 1)

    def line(i: Column) -> Column:
        products = F.transform(places, lambda j: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x[i] * x[j]))
        ridged = F.transform(products, lambda v, j: F.when(i == j, v + ridge[j]).otherwise(v))
        return F.concat(ridged, F.array(F.aggregate(rows(), F.lit(0.0), lambda a, k: a + xs[k][i] * ys[k])))

    return F.transform(places, line)


def solved(system: Column, p: int) -> Column:
    """Solution of a positive definite system by elimination."""

    def step(m: Column, k: Column) -> Column:
        pivot = F.transform(m[k], lambda v: v / m[k][k])
        return bound(pivot, lambda own: F.transform(
            m, lambda row, i: F.when(i == k, own).otherwise(F.zip_with(row, own, lambda a, b: a - row[k] * b))
        ))

    return F.transform(F.aggregate(F.sequence(F.lit(0), F.lit(p - 1)), system, step), lambda row: row[p])


def changing_components(
    series: DataFrame, keys: Sequence[str] = config.KEYS, settings: config.DecompositionSettings = SETTINGS
) -> DataFrame:
    """Adds ``trend``, ``weekly`` and ``yearly`` to rows with ``ds`` and ``y``; a NULL y counts as no day.

    The values of a series are scaled by their largest size, so the penalties do not depend on units.
    """
    rest = [c for c in series.columns if c not in keys]
    gathered = series.filter(F.col("y").isNotNull()).groupBy(*keys).agg(
        F.min("ds").alias("_first"), F.max("ds").alias("_last"),
        F.greatest(F.max(F.abs(F.col("y").cast("double"))), F.lit(1e-9)).alias("_size"),
        F.sort_array(F.collect_list(F.struct(F.col("ds").alias("_ds"), F.struct(*rest).alias("row")))).alias("_rows"),
    )
    span = F.greatest(F.datediff("_last", "_first"), F.lit(1)).cast("double")
    start, penalty = F.lit("1970-01-01").cast("date"), penalties(settings)

    def parts(ds: Column) -> list[list[Column]]:
        return basis(F.datediff(ds, start).cast("double"), F.datediff(ds, F.col("_first")) / span, settings)

    xs = F.transform("_rows", lambda r: F.array(*[c for part in parts(r["_ds"]) for c in part]))
    ys = F.transform("_rows", lambda r: r["row"]["y"].cast("double") / F.col("_size"))
    weights = bound(xs, lambda x: bound(ys, lambda y: solved(normal_equations(x, y, penalty), len(penalty))))
    fitted = gathered.withColumn("_weights", weights).select(*keys, "_first", "_last", "_size", "_weights", F.explode("_rows").alias("_r"))
    found, at = {}, 0
    for name, part in zip(("trend", "weekly", "yearly"), parts(F.col("_r._ds"))):
        terms = [F.col("_weights")[at + i] * c for i, c in enumerate(part)]
        found[name], at = sum(terms, F.lit(0.0)) * F.col("_size"), at + len(part)
    return fitted.select(*keys, *[F.col(f"_r.row.`{c}`").alias(c) for c in rest], *[c.alias(n) for n, c in found.items()])
