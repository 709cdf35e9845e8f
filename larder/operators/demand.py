"""Demand: daily series, decomposition, forecasts, corrections and uncertainty.

A series holds one row per day with a sale, so a window over one site and SKU is bounded by
the days of the history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from larder import config
from larder.functions.grouping import exact_quantiles
from larder.functions.quantities import clipped, guarded_ratio
from larder.operators.boosting import INPUTS, grown, prepared
from larder.operators.decompose import changing_components
from larder.operators.gold import attach_sku
from larder.operators.phantom import NoRowsError
from larder.operators.quantile_trees import pinball_loss, quantile_predict, quantile_train
from larder.session import work_dir

KEYS = list(config.KEYS)


def _series() -> WindowSpec:
    return Window.partitionBy(*KEYS)


def daily_demand(
    movements: DataFrame,
    reference_date: dt.date,
    registry: DataFrame | None = None,
    weeks: int = config.HISTORY_WEEKS,
) -> DataFrame:
    """Quantity sold per site, SKU and day over the history window."""
    item = "unified_sku_id" if registry is None else "MATNR"
    sold = (
        movements.filter(
            (F.col("BWART") == config.SALE)
            & (F.col("BUDAT") >= F.lit(reference_date - dt.timedelta(days=weeks * 7)))
        )
        .groupBy("WERKS", item, "BUDAT")
        .agg(F.sum("MENGE").alias("y"))
    )
    if registry is not None:
        sold = (
            attach_sku(sold, registry)
            .groupBy("WERKS", "unified_sku_id", "BUDAT")
            .agg(F.sum("y").alias("y"))
        )
    return sold.select(
        F.col("WERKS").alias("werks"), "unified_sku_id", F.col("BUDAT").alias("ds"), "y"
    )


def history_gate(series: DataFrame, min_days: int) -> DataFrame:
    """Series with enough days; shorter ones drop out."""
    return (
        series.withColumn("_days", F.count(F.lit(1)).over(_series()))
        .filter(F.col("_days") >= min_days)
        .drop("_days")
    )


def history_summary(series: DataFrame) -> DataFrame:
    """Days per series and which gates it passes."""
    return (
        series.groupBy(*KEYS)
        .agg(F.count(F.lit(1)).alias("n_days"))
        .withColumn("can_train", F.col("n_days") >= config.TRAIN_MIN_DAYS)
        .withColumn("can_score", F.col("n_days") >= config.SCORE_MIN_DAYS)
    )


def seasonal_components(series: DataFrame) -> DataFrame:
    """Additive split of every series: linear trend, then weekday, then week of the year.

    All windows start with the series key, so one shuffle serves them all.
    """
    y = F.col("y").cast("double")
    step = F.datediff("ds", F.min("ds").over(_series())).cast("double")
    by_weekday = Window.partitionBy(*KEYS, "_weekday")
    by_week = Window.partitionBy(*KEYS, "_week")
    return (
        series.withColumns({"_y": y, "_x": step})
        .withColumn(
            "trend",
            F.coalesce(
                F.regr_intercept("_y", "_x").over(_series())
                + F.regr_slope("_y", "_x").over(_series()) * F.col("_x"),
                F.avg("_y").over(_series()),
            ),
        )
        .withColumns({"_weekday": F.weekday("ds"), "_week": F.weekofyear("ds")})
        .withColumn("weekly", F.avg(F.col("_y") - F.col("trend")).over(by_weekday))
        .withColumn(
            "yearly", F.avg(F.col("_y") - F.col("trend") - F.col("weekly")).over(by_week)
        )
        .drop("_y", "_x", "_weekday", "_week")
    )


def calendar_features(
    rows: DataFrame, holidays: DataFrame, day: str | Column = "ds"
) -> DataFrame:
    """Weekday (Monday 0), ISO week and public-holiday flag.

    ``holidays`` holds about ten rows per year, whatever the data size, so it is broadcast.
    """
    date = F.col(day) if isinstance(day, str) else day
    marked = holidays.select(F.col("holiday_date").alias("_day"), F.lit(1).alias("_holiday"))
    return (
        rows.withColumn("_day", date)
        .join(F.broadcast(marked), "_day", "left")
        .withColumns(
            {
                "day_of_week": F.weekday("_day"),
                "week_of_year": F.weekofyear("_day"),
                "is_public_holiday": F.coalesce("_holiday", F.lit(0)),
            }
        )
        .drop("_day", "_holiday")
    )


def stock_context(rows: DataFrame, stock: DataFrame) -> DataFrame:
    """Adds stock and cover; series without a stock row drop out."""
    return rows.join(
        stock.select(
            *KEYS,
            F.col("stock_qty").cast("double").alias("stock_qty"),
            F.col("days_of_cover").cast("double").alias("days_of_cover"),
        ),
        KEYS,
        "inner",
    )


def forward_demand(
    series: DataFrame, horizons: Sequence[int] = config.HORIZONS
) -> DataFrame:
    """Sum of the next n rows of the series, NULL near its end; negative demand counts as 0."""
    in_order = _series().orderBy("ds")
    floored = series.withColumn("y", F.greatest("y", F.lit(0).cast(series.schema["y"].dataType)))
    return floored.withColumns(
        {
            f"demand_{h}d": F.when(
                F.count(F.lit(1)).over(in_order.rowsBetween(1, h)) == h,
                F.sum("y").over(in_order.rowsBetween(1, h)),
            )
            for h in horizons
        }
    )


def m1_training_rows(
    series: DataFrame,
    holidays: DataFrame,
    stock: DataFrame,
    min_days: int = config.TRAIN_MIN_DAYS,
) -> DataFrame:
    """Inputs and targets of the base forecast; incomplete rows drop out."""
    split = changing_components(history_gate(series, min_days))
    framed = forward_demand(stock_context(calendar_features(split, holidays), stock))
    targets = [f"demand_{h}d" for h in config.HORIZONS]
    return framed.dropna(subset=[*targets, *config.DEMAND_FEATURES]).withColumns(
        {t: F.col(t).cast("double") for t in targets}
    )


def m1_scoring_rows(
    series: DataFrame,
    holidays: DataFrame,
    stock: DataFrame,
    run_date: dt.date,
    min_days: int = config.SCORE_MIN_DAYS,
) -> DataFrame:
    """Last row of each series with the calendar of the run date."""
    newest = Window.partitionBy(*KEYS).orderBy(F.col("ds").desc())
    last = (
        changing_components(history_gate(series, min_days))
        .withColumn("_rank", F.row_number().over(newest))
        .filter("_rank = 1")
        .select(*KEYS, "trend", "weekly", "yearly")
    )
    return stock_context(calendar_features(last, holidays, F.lit(run_date)), stock)


def _fit(
    steps: PipelineModel, rows: DataFrame, target: str, output: str, trees: config.TreeSettings
) -> PipelineModel:
    model = grown(GBTRegressor(labelCol=target, predictionCol=output), rows, trees)
    return PipelineModel([*steps.stages, model])


def _as_doubles(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast("double") for c in columns})


def m1_train(
    training: DataFrame,
    trees: config.TreeSettings = config.DEMAND_TREES,
    horizons: Sequence[int] = config.HORIZONS,
) -> dict[int, PipelineModel]:
    """One boosted-tree regressor per horizon, fitted side by side on the same prepared rows.

    A fold of sites and SKUs is held back and ends the growing.
    """
    rows = _as_doubles(training, config.DEMAND_FEATURES)
    if rows.isEmpty():
        raise NoRowsError("no series is long enough to train on")
    steps, ready = prepared(config.DEMAND_FEATURES, rows, KEYS)
    with ThreadPoolExecutor(len(horizons)) as pool:
        fits = {
            h: pool.submit(
                inheritable_thread_target(rows.sparkSession)(_fit),
                steps, ready, f"demand_{h}d", f"raw_{h}d", trees,
            )
            for h in horizons
        }
        return {h: fit.result() for h, fit in fits.items()}


def m1_predict(models: dict[int, PipelineModel], features: DataFrame) -> DataFrame:
    """Adds the plain prediction of every horizon as ``raw_<n>d``."""
    rows = _as_doubles(features, config.DEMAND_FEATURES)
    helpers = [f"{c}_{made}" for c in config.DEMAND_FEATURES for made in ("filled", "bin")]
    for horizon, model in models.items():
        rows = model.transform(rows).drop(INPUTS, *helpers)
    return rows


def m1_score(models: dict[int, PipelineModel], features: DataFrame) -> DataFrame:
    """Forecast per horizon, never below zero."""
    return clip_forecasts(m1_predict(models, features))


def clip_forecasts(raw: DataFrame, pattern: str = "raw_{}d") -> DataFrame:
    """Names the horizons and lifts negative forecasts to zero."""
    return raw.select(
        *KEYS,
        *[
            clipped(F.col(pattern.format(h)), low=0.0).alias(f"forecast_{h}d")
            for h in config.HORIZONS
        ],
    )


def actual_demand(
    movements: DataFrame,
    first_day: dt.date,
    horizons: Sequence[int] = (7,),
    registry: DataFrame | None = None,
) -> DataFrame:
    """Quantity sold in the first n days from ``first_day`` on, as ``actual_<n>d``."""
    item = "unified_sku_id" if registry is None else "MATNR"
    columns = [f"actual_{h}d" for h in horizons]

    def before(h: int) -> Column:
        return F.col("BUDAT") < F.lit(first_day + dt.timedelta(days=h))

    merged = (
        movements.filter(
            (F.col("BWART") == config.SALE)
            & (F.col("BUDAT") >= F.lit(first_day))
            & before(max(horizons))
        )
        .groupBy("WERKS", item)
        .agg(*[F.sum(F.when(before(h), F.col("MENGE"))).alias(c) for h, c in zip(horizons, columns)])
    )
    if registry is not None:
        merged = (
            attach_sku(merged, registry)
            .groupBy("WERKS", "unified_sku_id")
            .agg(*[F.sum(c).alias(c) for c in columns])
        )
    return merged.select(F.col("WERKS").alias("werks"), "unified_sku_id", *columns)


def recent_sales(
    movements: DataFrame,
    reference_date: dt.date,
    days: int = 7,
    registry: DataFrame | None = None,
) -> DataFrame:
    """Quantity sold since ``days`` before the reference date (that day included)."""
    first = reference_date - dt.timedelta(days=days)
    return actual_demand(movements, first, (days + 1,), registry).withColumnRenamed(
        f"actual_{days + 1}d", f"actual_{days}d"
    )


def hold_out_forecasts(
    series: DataFrame,
    stock_at: Callable[[dt.date], DataFrame],
    holidays: DataFrame,
    origins: Sequence[dt.date],
    trees: config.TreeSettings = config.DEMAND_TREES,
    min_days: int = config.TRAIN_MIN_DAYS,
) -> DataFrame:
    """Forecasts made on past days with the demand that followed, one fold per origin.

    Series, their split, stock, targets and models of a fold know days up to its origin only. Demand
    is that of the next n rows of the series, as in ``forward_demand``, and NULL where fewer follow.
    Gives keys, fold, origin, forecast_<n>d and demand_<n>d.
    """
    if not origins:
        raise NoRowsError("no origin to forecast from")
    folds = []
    for number, origin in enumerate(origins):
        known, stock = series.filter(F.col("ds") <= F.lit(origin)), stock_at(origin)
        models = m1_train(m1_training_rows(known, holidays, stock, min_days), trees)
        forecasts = m1_score(models, m1_scoring_rows(known, holidays, stock, origin))
        place = F.row_number().over(_series().orderBy("ds"))
        ahead = series.filter(F.col("ds") > F.lit(origin)).withColumn("_place", place).filter(F.col("_place") <= max(config.HORIZONS))
        later = ahead.groupBy(*KEYS).agg(*[
            F.when(F.count(F.lit(1)) >= h, F.sum(F.when(F.col("_place") <= h, F.greatest(F.col("y").cast("double"), F.lit(0.0)))))
            .alias(f"demand_{h}d")
            for h in config.HORIZONS
        ])
        folds.append(forecasts.join(later, KEYS, "left").withColumns({"fold": F.lit(number), "origin": F.lit(origin)}))
    return reduce(DataFrame.unionByName, folds)


def hold_out_error(
    scored: DataFrame, limits: config.ForecastLimits = config.ForecastLimits()
) -> DataFrame:
    """Per fold and horizon: rows, mean absolute error, mean demand, their ratio, and the release gate."""
    rows = F.array(*[
        F.struct(F.lit(h).alias("horizon_days"), F.col(f"forecast_{h}d").alias("forecast"), F.col(f"demand_{h}d").alias("actual"))
        for h in config.HORIZONS
    ])
    share = F.when(F.col("mean_demand") > 0, F.col("mae") / F.col("mean_demand"))
    return (
        scored.select("fold", F.inline(rows))
        .groupBy("fold", "horizon_days")
        .agg(
            F.count("actual").alias("n_rows"),
            F.avg(F.abs(F.col("forecast") - F.col("actual"))).alias("mae"),
            F.avg("actual").alias("mean_demand"),
        )
        .withColumn("mae_share", share)
        .withColumn("passes", F.coalesce(F.col("mae_share") <= limits.mae_share_gate, F.lit(False)))
    )


def forecast_error(
    forecasts: DataFrame,
    actuals: DataFrame,
    limits: config.ForecastLimits = config.ForecastLimits(),
) -> DataFrame:
    """Mean absolute error per horizon, its share of mean demand, and the release gate.

    Every forecast counts: a series that sold nothing has an actual demand of zero.
    """
    joined = forecasts.join(actuals, KEYS, "left")
    parts = []
    for h in config.HORIZONS:
        actual = F.coalesce(F.col(f"actual_{h}d").cast("double"), F.lit(0.0))
        parts += [
            F.avg(F.abs(F.col(f"forecast_{h}d") - actual)).alias(f"mae_{h}d"),
            F.avg(actual).alias(f"mean_{h}d"),
        ]
    totals = joined.agg(*parts)
    rows = F.array(
        *[
            F.struct(
                F.lit(h).alias("horizon_days"),
                F.col(f"mae_{h}d").alias("mae"),
                F.col(f"mean_{h}d").alias("mean_demand"),
            )
            for h in config.HORIZONS
        ]
    )
    share = F.when(F.col("mean_demand") > 0, F.col("mae") / F.col("mean_demand"))
    return (
        totals.select(F.inline(rows))
        .withColumn("mae_share", share)
        .withColumn(
            "passes", F.coalesce(F.col("mae_share") <= limits.mae_share_gate, F.lit(False))
        )
    )


def short_history_fallback(
    forecasts: DataFrame, days: DataFrame, categories: DataFrame, min_days: int
) -> DataFrame:
    """Series without enough history take the median forecast of their category.

    ``categories`` lists every series that needs a forecast. The medians come from series
    with enough history only.
    """
    columns = [f"forecast_{h}d" for h in config.HORIZONS]
    known = (
        categories.select(*KEYS, "category")
        .join(days.select(*KEYS, "n_days"), KEYS, "left")
        .join(forecasts.select(*KEYS, *columns), KEYS, "left")
        .withColumn(
            "is_fallback",
            (F.coalesce("n_days", F.lit(0)) < min_days) | F.col(columns[0]).isNull(),
        )
    )
    path = work_dir(known.sparkSession, "known")
    known.write.parquet(path)
    known = known.sparkSession.read.schema(known.schema).parquet(path)
    named = F.map_from_arrays(F.array(*map(F.lit, columns)), F.array(*columns))
    medians = (
        exact_quantiles(
            known.filter(~F.col("is_fallback")).select(
                "category", F.explode(named).alias("_column", "_forecast")
            ),
            ["category", "_column"],
            "_forecast",
            {"_median": 0.5},
        )
        .groupBy("category")
        .agg(
            *[
                F.max(F.when(F.col("_column") == c, F.col("_median"))).alias(f"_{c}")
                for c in columns
            ]
        )
    )
    filled = {
        c: F.when(F.col("is_fallback"), F.col(f"_{c}")).otherwise(F.col(c)) for c in columns
    }
    out = known.join(medians, "category", "left").withColumns(filled)
    return out.select(*KEYS, "category", *columns, "is_fallback")


def weather_summary(forecast: DataFrame, days: int | None = config.WEATHER_DAYS) -> DataFrame:
    """One row: mean temperature and rain of the first days, as distance from the norms.

    Missing rain counts as none, a missing temperature is left out. ``days=None`` takes
    the whole table, as training does.
    """
    rows = forecast if days is None else forecast.orderBy("forecast_date").limit(days)
    return rows.agg(
        F.avg("temperature_max").alias("_t"),
        F.avg(F.coalesce("precipitation", F.lit(0.0))).alias("_p"),
    ).select(
        (F.col("_t") - config.TEMPERATURE_NORM).alias("temperature_delta"),
        (F.col("_p") - config.PRECIPITATION_NORM).alias("precipitation_delta"),
    )


_WEATHER_INPUTS = ("temperature_delta", "precipitation_delta")


def weather_training_rows(lifts: DataFrame, weather: DataFrame) -> DataFrame:
    """Observed lifts with the weather they were observed in."""
    summary = weather_summary(weather, None)
    return lifts.select(
        "actual_lift", *[summary.select(c).scalar().alias(c) for c in _WEATHER_INPUTS]
    )


def weather_train(
    rows: DataFrame, trees: config.TreeSettings = config.WEATHER_TREES
) -> PipelineModel:
    """Lift as a function of the two weather distances."""
    if rows.isEmpty():
        raise NoRowsError("no lifts to train on")
    steps, ready = prepared(_WEATHER_INPUTS, rows)
    return _fit(steps, ready, "actual_lift", "_raw_lift", trees)


def weather_lift(model: PipelineModel, summary: DataFrame) -> DataFrame:
    """One row with the lift for the given weather, inside its allowed range."""
    if summary.filter(F.col("temperature_delta").isNotNull()).isEmpty():
        raise NoRowsError("no weather forecast")
    return clip_lift(model.transform(summary), "_raw_lift").select("weather_lift")


def clip_lift(rows: DataFrame, raw: str, name: str = "weather_lift") -> DataFrame:
    return rows.withColumn(name, clipped(F.col(raw), *config.LIFT_RANGE))


def actual_lift(forecasts: DataFrame, actuals: DataFrame) -> DataFrame:
    """Observed over forecast week, with small forecasts counted as one unit."""
    base = F.greatest(F.col("forecast_7d").cast("double"), F.lit(1.0))
    ratio = F.col("actual_7d").cast("double") / base
    return forecasts.join(actuals.select(*KEYS, "actual_7d"), KEYS, "inner").select(
        *KEYS, clipped(ratio, *config.LIFT_RANGE).alias("actual_lift")
    )


def promo_lift(
    forecasts: DataFrame, actuals: DataFrame, calendar: DataFrame | None = None
) -> DataFrame:
    """Mean lift over the promotions of a site and SKU; 1.0 for all without a calendar."""
    if calendar is None:
        return forecasts.select(*KEYS, F.lit(1.0).alias("promo_lift"))
    base = F.greatest(F.col("baseline_demand").cast("double"), F.lit(1.0))
    ratio = F.col("actual_7d").cast("double") / base
    return (
        calendar.join(actuals.select(*KEYS, "actual_7d"), KEYS, "inner")
        .groupBy(*KEYS)
        .agg(F.avg(clipped(ratio, *config.LIFT_RANGE)).alias("promo_lift"))
    )


def m2_corrected(forecasts: DataFrame, promo: DataFrame, weather_lift: Column) -> DataFrame:
    """Forecast times promotion lift times weather lift, never below zero.

    ``weather_lift`` is a literal or a scalar subquery over the one-row lift table.
    """
    lifted = (
        forecasts.join(promo.select(*KEYS, "promo_lift"), KEYS, "left")
        .withColumn("promo_lift", F.coalesce(F.col("promo_lift").cast("double"), F.lit(1.0)))
        .withColumn("weather_lift", weather_lift)
    )
    return lifted.select(
        *KEYS,
        *[
            clipped(
                F.col(f"forecast_{h}d") * F.col("promo_lift") * F.col("weather_lift"), low=0.0
            ).alias(f"corrected_{h}d")
            for h in config.HORIZONS
        ],
        "promo_lift",
        "weather_lift",
    )


_CORRECTED = [*(f"corrected_{h}d" for h in config.HORIZONS), "promo_lift", "weather_lift"]


def m2_residuals(corrected: DataFrame, actuals: DataFrame) -> DataFrame:
    """Observed minus corrected week; rows with a missing input drop out."""
    return (
        corrected.join(actuals.select(*KEYS, "actual_7d"), KEYS, "inner")
        .withColumn("residual_7d", F.col("actual_7d").cast("double") - F.col("corrected_7d"))
        .dropna(subset=[*_CORRECTED, "residual_7d"])
        .select(*KEYS, *_CORRECTED, "residual_7d")
    )


GLOBAL_GROUP = "*"


def residual_quantiles(residuals: DataFrame, categories: DataFrame) -> DataFrame:
    """P10, P50 and P90 of the residuals per category, and over all rows under ``*``."""
    tagged = residuals.join(categories.select(*KEYS, "category"), KEYS, "left").select(
        "residual_7d",
        F.explode(
            F.array_distinct(
                F.array(F.coalesce("category", F.lit(GLOBAL_GROUP)), F.lit(GLOBAL_GROUP))
            )
        ).alias("category"),
    )
    quantiles = exact_quantiles(tagged, ["category"], "residual_7d", config.QUANTILES)
    return quantiles.withColumnsRenamed({n: f"residual_{n}" for n in config.QUANTILES})


def residual_trees(
    residuals: DataFrame, trees: config.TreeSettings = config.QUANTILE_TREES, by: Sequence[str] = KEYS
) -> DataFrame:
    """Quantile trees of the residual over forecasts and lifts, as a model table.

    ``by`` names the columns whose hash deals the held-back fold. With few residuals the table is empty or holds one overall value per quantile.
    """
    return quantile_train(residuals, _CORRECTED, "residual_7d", by, config.QUANTILES, trees)


def predicted_residuals(model: DataFrame, corrected: DataFrame) -> DataFrame:
    """Adds ``tree_<quantile>`` of the residual to every corrected forecast."""
    return quantile_predict(model, corrected, _CORRECTED, "tree_{}")


def quantile_scores(predicted: DataFrame, actual: str, names: dict[str, str]) -> DataFrame:
    """Per quantile: rows, share of values at or below the estimate, and mean pinball loss.

    ``names`` maps the quantiles to the columns of their estimates.
    """
    value = F.col(actual).cast("double")
    rows = F.array(*[
        F.struct(
            F.lit(q).alias("quantile"), (value <= F.col(c)).cast("int").alias("covered"),
            pinball_loss(value, F.col(c), config.QUANTILES[q]).alias("loss"),
        )
        for q, c in names.items()
    ])
    return predicted.select(F.inline(rows)).groupBy("quantile").agg(
        F.count("loss").alias("n_rows"), F.avg("covered").alias("coverage"), F.avg("loss").alias("pinball_loss")
    )


def quantile_forecast(
    corrected: DataFrame, categories: DataFrame, quantiles: DataFrame, model: DataFrame | None = None
) -> DataFrame:
    """Corrected week plus residual quantiles, in ascending order.

    The quantiles come from the trees of ``model`` where they give one. Elsewhere they are those of
    the category, and categories without residuals use the overall quantiles.
    """
    names = list(config.QUANTILES)
    overall = quantiles.filter(F.col("category") == GLOBAL_GROUP)
    if model is None:
        corrected = corrected.withColumns({f"tree_{n}": F.lit(None).cast("double") for n in names})
    else:
        corrected = predicted_residuals(model, corrected)
    joined = (
        corrected.join(categories.select(*KEYS, "category"), KEYS, "left")
        .join(quantiles.filter(F.col("category") != GLOBAL_GROUP), "category", "left")
        .withColumns(
            {
                n: clipped(
                    F.col("corrected_7d")
                    + F.coalesce(F.col(f"tree_{n}"), F.col(f"residual_{n}"), overall.select(f"residual_{n}").scalar()),
                    low=0.0,
                )
                for n in names
            }
        )
    )
    return sorted_quantiles(joined)


def sorted_quantiles(rows: DataFrame) -> DataFrame:
    """Puts p10, p50 and p90 in ascending order and adds their spread."""
    names = list(config.QUANTILES)
    return (
        rows.withColumn("_q", F.array_sort(F.array(*names)))
        .select(*KEYS, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
        .withColumn("uncertainty_spread", F.col("p90") - F.col("p10"))
    )
