"""The daily run, step by step. Each step reads tables, writes tables and takes its clock.

Steps hand over through tables below one root folder, so a step can be repeated on its own
and no plan grows across steps. Safety gates run on written tables, before anything is
emitted.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import config
from larder.functions.calendar import dutch_public_holidays
from larder.operators import demand, edi, features, gold, ordering, phantom, review, silver, sweep
from larder.sources import sinks
from larder.sources.feeds import FEEDS
from larder.sources.weather import weather_rows
from larder.streaming import bronze

KEYS = list(config.KEYS)


@dataclass(frozen=True)
class Store:
    """Tables as folders below a root all executors can reach."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        sinks.publish_overwrite(df, self.path(name))
        return self.read(name).drop("_computed_at")


def ingest(store: Store, feed_name: str, landing: str) -> None:
    """Loads the new files of a feed into its bronze table."""
    feed = FEEDS[feed_name]
    schema = bronze.grown_schema(store.spark, landing, feed.schema)
    stream = bronze.read_feed_stream(store.spark, landing, schema)
    bronze.append_available(
        bronze.with_audit_columns(stream),
        store.path(feed.target),
        store.path(f"_checkpoints/{feed.folder}"),
    )


def refine(store: Store, source_banner: str) -> None:
    """Bronze to silver. Load columns stay behind, so re-delivered rows compare equal."""

    def landed(name: str) -> DataFrame:
        feed = FEEDS[name]
        rows = bronze.read_evolved(store.spark, store.path(feed.target))
        return rows.select(*[f.name for f in feed.schema.fields])

    landed_materials = landed("materials")
    materials = store.replace(
        "silver/materials_clean", silver.clean_materials(landed_materials)
    )
    registry = store.replace(
        "silver/sku_registry", silver.sku_registry(landed_materials, source_banner)
    )
    dimension = store.replace(
        "silver/material_dimension", silver.material_dimension(materials, registry)
    )
    inventory = store.replace(
        "silver/inventory_clean", silver.clean_inventory(landed("inventory"))
    )
    store.replace(
        "silver/enriched_movements", silver.enriched_movements(inventory, dimension)
    )
    store.replace("silver/open_orders_clean", silver.clean_open_orders(landed("open_orders")))


def aggregate(store: Store, reference_date: dt.date) -> None:
    """Silver to gold; the movements are read once, for the rollup."""
    registry = store.read("silver/sku_registry")
    moves = store.read("silver/inventory_clean").filter(F.col("BUDAT") <= F.lit(reference_date))
    rollup = store.replace("gold/rollup", gold.movement_rollup(moves, reference_date, registry))
    store.replace("gold/daily_positions", gold.positions_of(rollup))
    store.replace("gold/velocity", gold.velocity_of(rollup))
    orders = store.read("silver/open_orders_clean")
    store.replace("gold/open_orders", gold.open_orders(orders, reference_date, registry))


def build_features(store: Store, reference_date: dt.date) -> None:
    """Feature tables with a checked key."""
    velocity = store.read("gold/velocity").drop("_computed_at")
    tables = {
        "velocity": features.velocity_features(velocity),
        "stock": features.stock_features(store.read("gold/daily_positions"), velocity),
        "collapse": features.collapse_signals(
            velocity,
            gold.last_sale_of(store.read("gold/rollup"), reference_date),
            store.read("silver/sku_registry"),
        ),
    }
    for name, df in tables.items():
        sinks.publish_features(df, store.path(f"features/{name}"), KEYS)


def feature_vector(store: Store) -> DataFrame:
    return features.feature_vector(
        *[store.read(f"features/{n}") for n in ("velocity", "stock", "collapse")]
    )


def train_phantom(
    store: Store, reference_date: dt.date, trees: config.TreeSettings = config.PHANTOM_TREES
) -> None:
    """Labels and features of the replayed days, then a model on the SKUs whose identity is
    certain; needs a ready registry."""
    registry = store.read("silver/sku_registry")
    if not silver.registry_ready(registry).first()["is_ready"]:
        raise RuntimeError("the SKU registry is below its match rate; training waits")
    days = store.replace(
        "gold/replayed_days",
        phantom.replayed_days(store.read("silver/inventory_clean"), reference_date, registry),
    )
    labels = store.replace("gold/training_labels", phantom.replayed_labels(days))
    confident = silver.confidence_filter(registry).select("unified_sku_id")
    training = store.replace(
        "gold/phantom_training",
        phantom.training_set(labels, phantom.replayed_features(days, registry), confident),
    )
    model = phantom.phantom_train(training, trees)
    model.write().overwrite().save(store.path("models/phantom"))


def score_phantom(
    store: Store,
    max_corrections: int = config.PhantomLimits().max_auto_corrections,
    run_id: str | None = None,
) -> DataFrame:
    """Scores, alerts, review rows, and the correction requests that may go out.

    A run that is repeated, under its name or with the same rows, has its review rows once.
    """
    model = PipelineModel.load(store.path("models/phantom"))
    scored = phantom.phantom_score(model, feature_vector(store)).withColumn(
        "_scored_at", F.current_timestamp()
    )
    scores = store.replace("gold/phantom_scores", scored)
    alerts = store.replace("gold/phantom_alerts", phantom.phantom_alerts(scores))
    sinks.publish_run(
        phantom.phantom_review_rows(scores), store.path("gold/phantom_review"), run_id, ignore=["_scored_at"]
    )
    return phantom.goods_movement_requests(phantom.writeback_cap(alerts, max_corrections))


def record_corrections(
    store: Store, requests: DataFrame, responses: DataFrame, run_id: str | None = None
) -> DataFrame:
    """Appends the outcome of correction requests to their audit log once per run; returns its counts."""
    audit = phantom.writeback_audit(requests, ordering.po_confirmations(responses))
    sinks.publish_run(audit, store.path("gold/writeback_audit"), run_id)
    return phantom.writeback_metrics(store.read("gold/writeback_audit"))


def train_demand(
    store: Store,
    reference_date: dt.date,
    mapping: DataFrame | None = None,
    min_days: int = config.TRAIN_MIN_DAYS,
    trees: config.TreeSettings = config.DEMAND_TREES,
) -> None:
    """Base forecast models. ``mapping`` assigns materials to series (default: the registry)."""
    series, stock = _demand_inputs(store, reference_date, mapping)
    rows = demand.m1_training_rows(series, _holidays(store, reference_date), stock, min_days)
    training = store.replace("demand/training", rows)
    for horizon, model in demand.m1_train(training, trees).items():
        model.write().overwrite().save(store.path(f"models/demand_{horizon}d"))


def hold_out_demand(
    store: Store,
    reference_date: dt.date,
    mapping: DataFrame | None = None,
    min_days: int = config.TRAIN_MIN_DAYS,
    trees: config.TreeSettings = config.DEMAND_TREES,
) -> DataFrame:
    """Error of the base forecast on the last four weeks, which its models have not seen."""
    split = reference_date - dt.timedelta(days=max(config.HORIZONS))
    names, moves = _mapping(store, mapping), store.read("silver/inventory_clean")
    before = moves.filter(F.col("BUDAT") <= F.lit(split))
    series = store.replace("demand/daily_before", demand.daily_demand(before, split, names))
    rollup = store.replace("demand/rollup_before", gold.movement_rollup(before, split, names))
    stock = features.stock_features(gold.positions_of(rollup), gold.velocity_of(rollup))
    holidays = _holidays(store, split)
    models = demand.m1_train(demand.m1_training_rows(series, holidays, stock, min_days), trees)
    inputs = demand.m1_scoring_rows(series, holidays, stock, split, config.SCORE_MIN_DAYS)
    actuals = demand.actual_demand(moves, split + dt.timedelta(days=1), config.HORIZONS, names)
    return store.replace("demand/held_out_error", demand.forecast_error(demand.m1_score(models, inputs), actuals))


def learn_weather(store: Store, bodies: DataFrame) -> None:
    """Stores the forecast days and fits the weather lift on the lifts seen last week."""
    weather = store.replace("demand/weather", weather_rows(bodies))
    lifts = demand.actual_lift(store.read("demand/m1_forecast"), store.read("demand/actuals"))
    model = demand.weather_train(
        store.replace("demand/weather_training", demand.weather_training_rows(lifts, weather))
    )
    model.write().overwrite().save(store.path("models/weather"))


def learn_quantiles(store: Store, trees: config.TreeSettings = config.QUANTILE_TREES) -> None:
    """Fits the residual quantiles on the residuals of the last scoring."""
    store.replace("models/residual_quantiles", demand.residual_trees(store.read("demand/m2_residuals"), trees))


def _exists(store: Store, name: str) -> bool:
    path = store.spark._jvm.org.apache.hadoop.fs.Path(store.path(name))
    return path.getFileSystem(store.spark._jsc.hadoopConfiguration()).exists(path)


def _weather_lift(store: Store, bodies: DataFrame) -> Column:
    """The lift of the coming days as a scalar, 1.0 until a model has been fitted."""
    if not _exists(store, "models/weather"):
        return F.lit(1.0)
    summary = demand.weather_summary(weather_rows(bodies))
    lift = demand.weather_lift(PipelineModel.load(store.path("models/weather")), summary)
    return store.replace("demand/weather_lift", lift).scalar()


def score_demand(
    store: Store,
    reference_date: dt.date,
    categories: DataFrame,
    weather: float | DataFrame,
    mapping: DataFrame | None = None,
    calendar: DataFrame | None = None,
    min_days: int = config.SCORE_MIN_DAYS,
) -> None:
    """Base forecast, fallback, corrections, residual quantiles and the probabilistic forecast.

    ``categories`` lists every series that needs a forecast; those with too short a history
    take the median of their category and are flagged in ``demand/with_fallback``.
    ``weather`` is a lift, or forecast bodies for the fitted weather model.
    """
    series, stock = _demand_inputs(store, reference_date, mapping)
    models = {
        h: PipelineModel.load(store.path(f"models/demand_{h}d")) for h in config.HORIZONS
    }
    inputs = demand.m1_scoring_rows(
        series, _holidays(store, reference_date), stock, reference_date, min_days
    )
    scored = store.replace("demand/m1_forecast", demand.m1_score(models, inputs))
    every = store.replace(
        "demand/with_fallback",
        demand.short_history_fallback(scored, demand.history_summary(series), categories, min_days),
    )
    columns = [f"forecast_{h}d" for h in config.HORIZONS]
    forecasts = every.select(*KEYS, *columns).dropna(subset=columns)
    actuals = store.replace(
        "demand/actuals",
        demand.recent_sales(
            store.read("silver/inventory_clean"), reference_date, 7, _mapping(store, mapping)
        ),
    )
    promo = demand.promo_lift(forecasts, actuals, calendar)
    lift = _weather_lift(store, weather) if isinstance(weather, DataFrame) else F.lit(float(weather))
    corrected = store.replace("demand/m2_corrected", demand.m2_corrected(forecasts, promo, lift))
    residuals = store.replace("demand/m2_residuals", demand.m2_residuals(corrected, actuals))
    quantiles = store.replace(
        "demand/residual_quantiles", demand.residual_quantiles(residuals, categories)
    )
    store.replace(
        "demand/m4_probabilistic",
        demand.quantile_forecast(
            corrected, categories, quantiles,
            store.read("models/residual_quantiles") if _exists(store, "models/residual_quantiles") else None,
        ),
    )


def _mapping(store: Store, mapping: DataFrame | None) -> DataFrame:
    return store.read("silver/sku_registry") if mapping is None else mapping


def _demand_inputs(store: Store, reference_date: dt.date, mapping: DataFrame | None):
    names = _mapping(store, mapping)
    moves = store.read("silver/inventory_clean").filter(F.col("BUDAT") <= F.lit(reference_date))
    series = store.replace("demand/daily", demand.daily_demand(moves, reference_date, names))
    rollup = store.replace("demand/rollup", gold.movement_rollup(moves, reference_date, names))
    stock = features.stock_features(gold.positions_of(rollup), gold.velocity_of(rollup))
    return series, stock


def _holidays(store: Store, reference_date: dt.date) -> DataFrame:
    first = reference_date - dt.timedelta(weeks=config.HISTORY_WEEKS)
    return dutch_public_holidays(store.spark, first.year, reference_date.year)


def order(
    store: Store,
    quantiles: DataFrame,
    lifts: DataFrame,
    stock: DataFrame,
    master: DataFrame,
    max_orders: int = config.OrderLimits().max_orders,
) -> DataFrame:
    """Recommendations, and the order requests that go out without a person."""
    output = store.replace(
        "gold/solver_output",
        ordering.solver_output(ordering.solver_inputs(quantiles, lifts, stock, master)),
    )
    recommendations = store.replace(
        "gold/order_recommendations", ordering.order_recommendations(output, quantiles)
    )
    return ordering.po_requests(ordering.po_cap(ordering.po_candidates(recommendations), max_orders))


def record_orders(
    store: Store, requests: DataFrame, responses: DataFrame, day: dt.date, run_id: str | None = None
) -> None:
    """Appends the outcome of requests to the audit log once per run, partitioned by run and day."""
    audit = ordering.po_audit(requests, ordering.po_confirmations(responses))
    sinks.publish_run(
        audit.withColumn("_created_on", F.lit(day)),
        store.path("gold/po_audit"),
        run_id,
        partition_by=["_created_on"],
    )


def load_exceptions(store: Store, quantiles: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Queue of the rows a person may have to look at. ``as_of`` is in UTC."""
    pending = sweep.pending_with_p50(store.read("gold/order_recommendations"), quantiles)
    minutes = sweep.minutes_to_deadline(sweep.wall_clock(F.lit(as_of.replace(tzinfo=None))))
    loaded_at = as_of.strftime("%Y-%m-%dT%H:%M:%SZ")
    return store.replace(
        "gold/exception_queue", sweep.exception_queue(pending, minutes, loaded_at)
    )


def finalize(store: Store, decisions: DataFrame | None = None) -> DataFrame:
    """Final status of every queue row; the rows that need an order carry a flag."""
    queue = store.read("gold/exception_queue").drop("_computed_at")
    if decisions is not None:
        queue = review.apply_decisions(queue, decisions)
    return store.replace("gold/finalized", sweep.finalize_status(queue))


def release(
    store: Store, master: DataFrame, day: dt.date, sender_id: str, timestamp: str
) -> DataFrame:
    """Order documents of the day as files, one folder per vendor; returns the file list."""
    consolidated = sweep.daily_po_consolidation(store.read("gold/po_audit"), master, day)
    lines = store.replace("gold/edi_lines", edi.edi_lines(sweep.empty_guard(consolidated), day))
    files = store.replace("gold/edi_files", edi.edi_files(lines, timestamp))
    table = store.path("gold/edi_documents")
    edi.edi_sink(edi.edi_documents(lines, sender_id, timestamp, files), table)
    edi.edi_hand_over(store.spark.read.parquet(table), store.path(f"edi/{timestamp}"))
    return files
