"""Phantom stock: labels, model, bands, corrections and their audit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder import config
from larder.functions.documents import document_sections
from larder.functions.grouping import latest_per_key, numbered_within
from larder.functions.quantities import QUANTITY, guarded_ratio, sale_quantity, signed_quantity
from larder.operators.backtest import Fold, rolling_origin
from larder.operators.boosting import grown, prepared
from larder.operators.explain import explained
from larder.operators.features import sales_per_key, shelf_life_by_sku
from larder.operators.gold import attach_sku

KEYS = list(config.KEYS)
LIMITS = config.PhantomLimits()

AUTO_CORRECTED = "AUTO_CORRECTED"
PENDING_REVIEW = "PENDING_REVIEW"
BELOW_THRESHOLD = "BELOW_THRESHOLD"


class SafetyCapExceeded(RuntimeError):
    """More automatic actions than a run may emit; nothing was emitted."""


class NoRowsError(ValueError):
    """A step that needs rows received none."""


def _is_phantom(limits: config.PhantomLimits) -> Column:
    suspicious = (
        (F.col("stock_qty") > 0)
        & (F.col("sales_7d") == 0)
        & (F.col("sales_28d") > limits.label_min_sales_28d)
    )
    return F.when(suspicious, 1).otherwise(0)


def phantom_labels(
    positions: DataFrame,
    velocity: DataFrame,
    label_date: dt.date | Column | None = None,
    limits: config.PhantomLimits = LIMITS,
) -> DataFrame:
    """1 where stock is booked, sales stopped this week and ran before; unknown stock is 0."""
    day = F.current_date() if label_date is None else F.lit(label_date)
    sales = sales_per_key(velocity, (7, 28))
    return positions.join(sales, KEYS, "inner").select(
        *KEYS, _is_phantom(limits).alias("is_phantom"), day.alias("label_date")
    )


def replayed_stretches(
    movements: DataFrame,
    reference_date: dt.date,
    registry: DataFrame | None = None,
    limits: config.PhantomLimits = LIMITS,
) -> DataFrame:
    """Stock, sales windows and last sale of every key over the days up to the reference date, one row for
    each stretch (``first_day`` to ``last_day``) in which nothing changes.

    A sale enters a window on its day and leaves it when the window has passed, so each
    movement becomes a few signed entries and running sums give stock and sales on every
    day something changes. All older history is summed onto the first day, so a key holds at most
    one row per replayed day, whatever its volume.
    """
    windows = config.SALES_WINDOWS
    first = reference_date - dt.timedelta(days=limits.replay_days - 1)
    oldest = first - dt.timedelta(days=max(windows) + 1)
    item = "unified_sku_id" if registry is None else "MATNR"
    per_day = (
        movements.filter(F.col("BUDAT") <= F.lit(reference_date))
        .withColumn("_day", F.greatest("BUDAT", F.lit(oldest)))
        .groupBy("WERKS", item, "_day")
        .agg(
            F.sum(signed_quantity()).alias("net"),
            F.sum(sale_quantity()).alias("sold"),
            F.count_if(F.col("BWART").isin(config.SALE, config.SALE_RETURN)).alias("n_sales"),
            F.max(F.when(F.col("BWART") == config.SALE, F.col("BUDAT"))).alias("last_sale"),
        )
    )
    none = F.lit(0)

    def entry(after: int) -> Column:
        """What changes so many days after the movement: all of it at once, then one window ends."""
        day = F.greatest(F.date_add("_day", after), F.lit(first))
        new = after == 0
        change = {n: F.col("sold") if new else -F.col("sold") if after == n + 1 else none for n in windows}
        return F.struct(
            day.alias("day"),
            (F.col("net") if new else none).cast("decimal(23,3)").alias("net"),
            *[c.cast("decimal(23,3)").alias(f"sales_{n}d") for n, c in change.items()],
            (F.col("n_sales") if new else none).cast("long").alias("seen"),
            (F.col("last_sale") if new else F.lit(None)).cast("date").alias("last_sale"),
        )

    sums = ("net", *[f"sales_{n}d" for n in windows], "seen")
    changes = (
        attach_sku(per_day, registry)
        .select(
            F.col("WERKS").alias("werks"),
            "unified_sku_id",
            F.explode(F.array(entry(0), *[entry(n + 1) for n in windows])).alias("_e"),
        )
        .filter(F.col("_e.day") <= F.lit(reference_date))
        .groupBy("werks", "unified_sku_id", F.col("_e.day").alias("day"))
        .agg(*[F.sum(f"_e.{c}").alias(c) for c in sums], F.max("_e.last_sale").alias("last_sale"))
    )
    ordered = Window.partitionBy(*KEYS).orderBy("day")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(
        F.date_sub(F.lead("day").over(ordered), 1), F.lit(reference_date)
    )
    return changes.select(
        *KEYS,
        F.sum("net").over(so_far).cast(QUANTITY).alias("stock_qty"),
        *[F.sum(f"sales_{n}d").over(so_far).cast(QUANTITY).alias(f"sales_{n}d") for n in windows],
        F.sum("seen").over(so_far).alias("seen"),
        F.max("last_sale").over(so_far).alias("last_sale"),
        F.col("day").alias("first_day"),
        until.alias("last_day"),
    ).filter("seen > 0").drop("seen")


def each_day(stretches: DataFrame) -> DataFrame:
    """Rows of stretches once for each of their days, as ``label_date``; a known last sale ages with them."""
    days = stretches.select("*", F.explode(F.sequence("first_day", "last_day")).alias("label_date"))
    if "days_since_last_sale" in stretches.columns:
        days = days.withColumn(
            "days_since_last_sale", F.col("days_since_last_sale") + F.datediff("label_date", "first_day")
        )
    return days.drop("first_day", "last_day")


def replayed_days(
    movements: DataFrame,
    reference_date: dt.date,
    registry: DataFrame | None = None,
    limits: config.PhantomLimits = LIMITS,
) -> DataFrame:
    """Stock, sales windows and last sale of every key on each of the days up to the reference date."""
    return each_day(replayed_stretches(movements, reference_date, registry, limits))


def label_replay(
    movements: DataFrame,
    reference_date: dt.date,
    registry: DataFrame | None = None,
    limits: config.PhantomLimits = LIMITS,
) -> DataFrame:
    """The label rule for each of the days up to the reference date."""
    return replayed_labels(replayed_days(movements, reference_date, registry, limits), limits)


def _days_of(rows: DataFrame) -> list[str]:
    """The columns that say for which days rows are: each of them, or the ends of a stretch."""
    return [c for c in ("label_date", "first_day", "last_day") if c in rows.columns]


def replayed_labels(days: DataFrame, limits: config.PhantomLimits = LIMITS) -> DataFrame:
    return days.select(*KEYS, _is_phantom(limits).alias("is_phantom"), *_days_of(days))


def replayed_features(days: DataFrame, registry: DataFrame) -> DataFrame:
    """The model inputs of every key on each replayed day, from ``replayed_days``, or on the first day of
    each stretch, from ``replayed_stretches``."""
    on = _days_of(days)
    cover = guarded_ratio(F.col("stock_qty"), F.col("sales_7d") / 7).try_cast("decimal(8,2)")
    ratio = guarded_ratio(F.col("sales_7d"), F.col("sales_28d")).cast("double")
    life = shelf_life_by_sku(registry).hint("shuffle_hash")
    return days.join(life, "unified_sku_id", "left").select(
        *KEYS,
        *on,
        *[f"sales_{n}d" for n in config.SALES_WINDOWS],
        "stock_qty",
        cover.alias("days_of_cover"),
        ratio.alias("velocity_collapse_ratio"),
        F.datediff(on[0], "last_sale").alias("days_since_last_sale"),
        "shelf_life_days",
    )


def training_set(
    labels: DataFrame, features: DataFrame, confident_skus: DataFrame | None = None
) -> DataFrame:
    """Labels with features; optionally only SKUs in the given (distinct) list.

    Features that carry a ``label_date`` meet the label of that day, those of a stretch its label. Replayed days are a small file
    of very many rows, so the joins name their method: a broadcast picked by the size of the file
    would take all rows through the driver. The list meets the features, which a join on the SKU
    may have shuffled already.
    """
    on = [*KEYS, *_days_of(features)]
    if confident_skus is not None:
        confident = confident_skus.select("unified_sku_id").hint("shuffle_hash")
        features = features.join(confident, "unified_sku_id", "left_semi")
    return labels.select(*on, "is_phantom").join(features.hint("merge"), on, "inner")


def model_inputs(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Model columns as doubles, plus a flag per column that may be missing."""
    return features.withColumns({c: F.col(c).cast("double") for c in columns}).withColumns(
        {f"{c}_missing": F.col(c).isNull().cast("double") for c in columns}
    )


def phantom_train(
    training: DataFrame,
    trees: config.TreeSettings = config.PHANTOM_TREES,
    columns: Sequence[str] = config.PHANTOM_FEATURES,
) -> PipelineModel:
    """Boosted-tree classifier; missing inputs take the mean and raise their flag.

    All rows are fitted on; those in the same bins are one weighted row, written once. A fold of sites
    and SKUs is held back and ends the growing.
    """
    flags = [f"{c}_missing" for c in columns]
    inputs = model_inputs(training, columns)
    steps, ready = prepared(columns, inputs, KEYS, flags, "is_phantom")
    return PipelineModel([*steps.stages, grown(GBTClassifier(labelCol="is_phantom"), ready, trees)])


def phantom_score(
    model: PipelineModel,
    features: DataFrame,
    columns: Sequence[str] = config.PHANTOM_FEATURES,
    limits: config.PhantomLimits = LIMITS,
) -> DataFrame:
    """Probability, band and explanation per site and SKU; an empty input is an error.

    ``shap_values`` are the Shapley values of this model for the row, as JSON text by column: what
    each column adds to the margin (half the log odds) over its mean.
    """
    scored = phantom_explained(model, features, columns)
    return phantom_banding(scored.select(*KEYS, "phantom_score", "shelf_life_days", "shap_values"), limits)


def phantom_explained(
    model: PipelineModel, features: DataFrame, columns: Sequence[str] = config.PHANTOM_FEATURES
) -> DataFrame:
    """Features with ``phantom_score``, its ``margin``, and ``base`` and ``contributions`` that add up to it."""
    if features.isEmpty():
        raise NoRowsError("no feature rows to score")
    inputs = model_inputs(features, columns)
    scored = model.transform(inputs).withColumns({
        "phantom_score": vector_to_array("probability")[1], "margin": vector_to_array("rawPrediction")[1],
    })
    return explained(model, scored, columns)


def phantom_banding(scores: DataFrame, limits: config.PhantomLimits = LIMITS) -> DataFrame:
    """Flag and action of every score."""
    score = F.col("phantom_score")
    return scores.withColumn("is_phantom", score >= limits.review_score).withColumn(
        "action",
        F.when(score >= limits.auto_correct_score, AUTO_CORRECTED)
        .when(score >= limits.review_score, PENDING_REVIEW)
        .otherwise(BELOW_THRESHOLD),
    )


def score_contributions(
    features: DataFrame,
    coefficients: dict[str, float],
    means: dict[str, Column],
) -> DataFrame:
    """Signed share of every input in an additive score, as a map and as JSON text.

    A contribution is ``coefficient * (value - mean)``; a missing value sits at the mean and
    contributes nothing. ``means`` takes literals or scalar subqueries.
    """
    parts = [
        F.coalesce(F.lit(float(c)) * (F.col(n).cast("double") - means[n]), F.lit(0.0))
        for n, c in coefficients.items()
    ]
    return features.withColumn(
        "contributions", F.map_from_arrays(F.array(*map(F.lit, coefficients)), F.array(*parts))
    ).withColumn("shap_values", F.to_json("contributions"))


def feature_means(features: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """Mean of each column, out of one scalar subquery; nothing passes through the driver."""
    means = features.agg(
        F.struct(*[(F.sum(c).cast("double") / F.count(c)).alias(c) for c in columns]).alias("m")
    ).scalar()
    return {c: means[c] for c in columns}


def phantom_alerts(scores: DataFrame) -> DataFrame:
    return scores.filter(F.col("action") != BELOW_THRESHOLD)


def phantom_review_rows(scores: DataFrame) -> DataFrame:
    """Rows for the append-only review log, not yet resolved."""
    return scores.filter(F.col("action") == PENDING_REVIEW).select(
        *KEYS,
        "phantom_score",
        "_scored_at",
        F.lit(None).cast("timestamp").alias("_resolved_at"),
        F.lit(None).cast("string").alias("_resolution"),
    )


def phantom_review_latest(log: DataFrame) -> DataFrame:
    """Present state of the review log: a resolution is a later row of the same key."""
    timed = log.withColumn("_event_at", F.coalesce("_resolved_at", "_scored_at"))
    return latest_per_key(timed, KEYS, ["_event_at"]).drop("_event_at")


def corrections_within_cap(alerts: DataFrame, cap: int = LIMITS.max_auto_corrections) -> DataFrame:
    """One row: number of automatic corrections, the cap, and whether they may go out."""
    return alerts.agg(F.count_if(F.col("action") == AUTO_CORRECTED).alias("n_rows")).select(
        "n_rows", F.lit(cap).alias("cap"), (F.col("n_rows") <= cap).alias("within_cap")
    )


def writeback_cap(alerts: DataFrame, cap: int = LIMITS.max_auto_corrections) -> DataFrame:
    """The automatic corrections, or an error before any of them is emitted."""
    auto = alerts.filter(F.col("action") == AUTO_CORRECTED)
    if auto.limit(cap + 1).count() > cap:
        raise SafetyCapExceeded(f"more than {cap} automatic stock corrections in one run")
    return auto


def goods_movement_requests(alerts: DataFrame) -> DataFrame:
    """One zero-stock request per automatic correction."""
    body = F.struct(
        F.col("werks").alias("WERKS"),
        F.col("unified_sku_id").alias("MATNR"),
        F.lit(config.MOVEMENT_CORRECTION).alias("BWART"),
        F.lit(0.0).alias("MENGE"),
    )
    return alerts.filter(F.col("action") == AUTO_CORRECTED).select(
        *KEYS, F.to_json(body).alias("payload")
    )


def goods_movement_documents(items: DataFrame, posting_date: str) -> DataFrame:
    """One movement document per plant as rows: header, movement code, then the items.

    A document is a table of its sections, so a plant with any number of items has one
    document and nothing is gathered.
    """
    line = F.struct(
        F.col("unified_sku_id").alias("MATERIAL"),
        F.col("werks").alias("PLANT"),
        F.col("storage_location").alias("STGE_LOC"),
        F.col("movement_type").alias("MOVE_TYPE"),
        F.col("quantity").alias("ENTRY_QNT"),
    )
    # One row per material and storage place: the plant is numbered over its materials.
    placed = numbered_within(
        items, "werks", "unified_sku_id", ["storage_location", "movement_type", "quantity"], "_line"
    )
    header = F.struct(
        F.lit(posting_date).alias("PSTNG_DATE"), F.lit(posting_date).alias("DOC_DATE")
    )
    code = F.struct(F.lit(config.GOODS_MOVEMENT_CODE).alias("GM_CODE"))
    return document_sections(
        placed, "werks", (("GOODSMVT_HEADER", header), ("GOODSMVT_CODE", code)), "GOODSMVT_ITEM", line
    )


def writeback_audit(requests: DataFrame, confirmations: DataFrame) -> DataFrame:
    """Requests with their outcome; a request without a confirmation is an error.

    ``confirmations`` hold one ``message``, or ``messages`` as ``po_confirmations`` gives them.
    """
    if "messages" in confirmations.columns:
        said = F.nullif(F.array_join("messages", "; "), F.lit("")).alias("message")
    else:
        said = F.col("message")
    answered = confirmations.select(*KEYS, "success", said)
    ok = F.coalesce("success", F.lit(False))
    return requests.join(answered, KEYS, "left").select(
        *KEYS,
        F.when(ok, "ok").otherwise("error").alias("status"),
        F.when(~ok, F.coalesce("message", F.lit("no confirmation"))).alias("message"),
    )


def writeback_metrics(audit: DataFrame) -> DataFrame:
    return audit.agg(
        F.count(F.lit(1)).alias("auto_corrected_count"),
        F.count_if(F.col("status") == "error").alias("bapi_error_count"),
    )


def backtest_scores(
    training: DataFrame,
    origins: Sequence[Fold],
    trees: config.TreeSettings = config.PHANTOM_TREES,
    limits: config.PhantomLimits = LIMITS,
) -> DataFrame:
    """Scores of past days, each by a model that saw the labels of earlier days only.

    ``training`` holds features and labels per key and ``label_date``.
    """

    def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
        scored = model.transform(model_inputs(rows, config.PHANTOM_FEATURES))
        scored = scored.withColumn("phantom_score", vector_to_array("probability")[1])
        return phantom_banding(scored.select(*KEYS, "label_date", "phantom_score"), limits)

    return rolling_origin(training, "label_date", origins, lambda known: phantom_train(known, trees), score)


def with_labels(rows: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """Rows per key and ``label_date`` with the label of that day as ``name``; those without one drop out.

    ``labels`` are for each day or for stretches of equal days, which are far fewer rows to shuffle. They
    are never broadcast: replayed days are small files of very many rows.
    """
    days = _days_of(labels)
    told = labels.select(*KEYS, *days, F.col("is_phantom").alias(name)).hint("merge")
    if "label_date" in days:
        return rows.join(told, [*KEYS, "label_date"], "inner")
    return rows.join(told, KEYS, "inner").filter(F.col("label_date").between(F.col("first_day"), F.col("last_day"))).drop(*days)


def backtest_precision(
    scores: DataFrame, labels: DataFrame, limits: config.PhantomLimits = LIMITS
) -> DataFrame:
    """Share of flagged rows the labels of the same day confirm, against the release gate.

    Scores have one row per key and ``label_date``, labels too or one per stretch of equal days. Only
    flagged rows are looked up.
    """
    flagged = scores.filter("is_phantom").select(*KEYS, "label_date", F.col("is_phantom").alias("_flagged"))
    return (
        with_labels(flagged, labels, "_label").withColumn("_true", F.col("_label") == 1)
        .agg(
            F.count_if(F.col("_flagged") & F.col("_true")).alias("true_positives"),
            F.count_if(F.col("_flagged") & ~F.col("_true")).alias("false_positives"),
        )
        .withColumn(
            "precision",
            F.when(
                F.col("true_positives") + F.col("false_positives") > 0,
                F.col("true_positives") / (F.col("true_positives") + F.col("false_positives")),
            ),
        )
        .withColumn("passes", F.coalesce(F.col("precision") >= limits.precision_gate, F.lit(False)))
    )
