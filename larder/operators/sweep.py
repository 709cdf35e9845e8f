"""Exception sweep before the order deadline, and the final decision on every row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import config
from larder.operators.phantom import NoRowsError

KEYS = list(config.KEYS)
LIMITS = config.SweepLimits()

AUTO_APPROVE = "AUTO_APPROVE"
ESCALATE = "ESCALATE"
BLOCK = "BLOCK"


def pending_with_p50(recommendations: DataFrame, quantiles: DataFrame) -> DataFrame:
    """Rows waiting for review with the present median forecast."""
    return (
        recommendations.filter(F.col("approval_status") == "PENDING_REVIEW")
        .drop("p50")
        .join(quantiles.select(*KEYS, "p50"), KEYS, "left")
    )


def quantity_deviation(quantity: Column, p50: Column) -> Column:
    """Distance of the order from the median, as a share of it; 0 without a median."""
    return F.when(p50 > 0, F.abs(quantity - p50) / p50).otherwise(0.0)


def wall_clock(instant: Column, zone: str = LIMITS.zone) -> Column:
    """Local time without zone of a UTC timestamp, whatever the session zone is."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), instant.cast("timestamp_ntz"))


def minutes_to_deadline(local_time: Column, limits: config.SweepLimits = LIMITS) -> Column:
    """Whole minutes from a local time to the deadline of the same day, never negative."""
    local = local_time.cast("timestamp_ntz")
    deadline = F.date_trunc("day", local) + F.make_dt_interval(
        hours=F.lit(limits.deadline_hour), mins=F.lit(limits.deadline_minute)
    )
    micros = F.timestamp_diff("MICROSECOND", local, deadline)
    return F.greatest(F.floor(micros / 60_000_000), F.lit(0)).cast("int")


def rule_transit(ratio: Column, limits: config.SweepLimits = LIMITS) -> Column:
    """BLOCK when too much of the shelf life passes in transit, else NULL."""
    return F.when(F.coalesce(ratio, F.lit(0.0)) > limits.transit_to_life, BLOCK)


def rule_deviation(deviation: Column, limits: config.SweepLimits = LIMITS) -> Column:
    """ESCALATE when the order strays from the median, else NULL."""
    return F.when(
        F.abs(F.coalesce(deviation, F.lit(0.0))) > limits.quantity_deviation, ESCALATE
    )


def rule_deadline(minutes_left: Column, limits: config.SweepLimits = LIMITS) -> Column:
    """ESCALATE while a person still has time to decide, else NULL."""
    return F.when(minutes_left > limits.cutoff_minutes, ESCALATE)


def rule_chain(
    ratio: Column, deviation: Column, minutes_left: Column, limits: config.SweepLimits = LIMITS
) -> Column:
    """Action of the first rule that objects; none objecting approves the row."""
    return F.coalesce(
        rule_transit(ratio, limits),
        rule_deviation(deviation, limits),
        rule_deadline(minutes_left, limits),
        F.lit(AUTO_APPROVE),
    )


def exception_type(
    ratio: Column, deviation: Column, minutes_left: Column, limits: config.SweepLimits = LIMITS
) -> Column:
    """Why a row needs attention; NULL for approved rows."""
    return (
        F.when(rule_transit(ratio, limits).isNotNull(), "High Transit-to-Life")
        .when(rule_deviation(deviation, limits).isNotNull(), "High Deviation")
        .when(rule_deadline(minutes_left, limits).isNotNull(), "Pending Deadline")
    )


def exception_queue(
    pending: DataFrame,
    minutes_left: Column,
    loaded_at: str | Column,
    contributions: Column | None = None,
    limits: config.SweepLimits = LIMITS,
) -> DataFrame:
    """The review queue: one row per pending order, decision columns still empty."""
    ratio = F.col("transit_to_life_ratio")
    deviation = F.col("quantity_deviation_pct")
    nothing = {
        "manager_decision": "string",
        "manager_id": "string",
        "decision_timestamp": "timestamp",
        "override_reason": "string",
        "override_qty": "int",
    }
    return (
        pending.withColumn(
            "quantity_deviation_pct",
            quantity_deviation(F.col("recommended_qty"), F.coalesce("p50", F.lit(0.0))),
        )
        .select(
            *KEYS,
            "recommended_qty",
            ratio,
            F.coalesce("order_value", F.lit(0.0)).alias("order_value"),
            deviation,
            rule_chain(ratio, deviation, minutes_left, limits).alias("sweeper_action"),
            exception_type(ratio, deviation, minutes_left, limits).alias("exception_type"),
            *[F.lit(None).cast(kind).alias(name) for name, kind in nothing.items()],
            (F.lit(None) if contributions is None else contributions)
            .cast("string")
            .alias("shap_values"),
            (F.lit(loaded_at) if isinstance(loaded_at, str) else loaded_at).alias("_loaded_at"),
        )
    )


def sweep_summary(queue: DataFrame) -> DataFrame:
    """Counts per action and the share nobody had to touch."""
    action = F.col("sweeper_action")
    return queue.agg(
        F.count(F.lit(1)).alias("pending_review_input_count"),
        F.count_if(action == AUTO_APPROVE).alias("processed"),
        F.count_if(action == BLOCK).alias("blocked"),
        F.count_if(action == ESCALATE).alias("escalated"),
    ).withColumn(
        "no_touch_rate",
        F.col("processed") / F.greatest(F.col("pending_review_input_count"), F.lit(1)),
    )


def finalize_status(queue: DataFrame) -> DataFrame:
    """Final status of every queue row and whether it becomes an order.

    Escalated rows without a decision are approved by force.
    """
    action, decision = F.col("sweeper_action"), F.col("manager_decision")
    status = (
        F.when(action == AUTO_APPROVE, "SWEEPER_AUTO_APPROVED")
        .when(action == BLOCK, "BLOCKED")
        .when(decision == "APPROVED", "MANAGER_APPROVED")
        .when(decision == "REJECTED", "MANAGER_REJECTED")
        .otherwise("FORCE_APPROVED")
    )
    return queue.withColumn("approval_status", status).withColumn(
        "needs_order", ~F.col("approval_status").isin("BLOCKED", "MANAGER_REJECTED")
    )


def finalize_metrics(audit: DataFrame, documents: DataFrame) -> DataFrame:
    """Run counters: decisions and order outcomes from the audit, files and lines from EDI.

    ``documents`` has one row per EDI file with its number of lines.
    """
    status, outcome = F.col("approval_status"), F.col("bapi_status")
    files = documents.agg(
        F.count(F.lit(1)).alias("f"), F.coalesce(F.sum("n_lines"), F.lit(0)).alias("n")
    )
    return audit.agg(
        F.count_if(status == "FORCE_APPROVED").alias("force_approved_count"),
        F.count_if(status == "MANAGER_APPROVED").alias("manager_approved_count"),
        F.count_if(status == "MANAGER_REJECTED").alias("manager_rejected_count"),
        F.count_if(outcome == "ok").alias("sweeper_bapi_created_count"),
        F.count_if(outcome == "error").alias("sweeper_bapi_error_count"),
    ).select(
        "*",
        files.select("f").scalar().alias("edi_files_generated"),
        files.select("n").scalar().alias("total_po_lines"),
    )


def daily_po_consolidation(audit: DataFrame, master: DataFrame, day: dt.date) -> DataFrame:
    """Orders created on a day with barcode, vendor, cost and transit time.

    A target partitioned by ``_created_on`` is read for that day only.
    """
    return audit.filter(
        (F.col("_created_on") == F.lit(day)) & (F.col("bapi_status") == "ok")
    ).join(
        master.select(*KEYS, "ean_barcode", "vendor_id", "unit_cost", "transit_days"),
        KEYS,
        "left",
    )


def empty_guard(consolidated: DataFrame) -> DataFrame:
    """The orders of the day, or an error when there are none."""
    if consolidated.isEmpty():
        raise NoRowsError("no approved orders for the day")
    return consolidated
