"""Business indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import config
from larder.operators.gold import attach_sku

KEYS = list(config.KEYS)

MANUAL = ("MANAGER_APPROVED",)


def weekly_mape(actuals: DataFrame, forecasts: DataFrame, categories: DataFrame) -> DataFrame:
    """Mean absolute percentage error per week and category; weeks without sales are skipped."""
    error = F.abs(F.col("actual") - F.col("forecast")) / F.col("actual")
    return (
        actuals.filter(F.col("actual") != 0)
        .join(forecasts, [*KEYS, "week"], "inner")
        .join(categories.select(*KEYS, "category"), KEYS, "inner")
        .groupBy("week", "category")
        .agg(F.avg(error).alias("mape"), F.count(F.lit(1)).alias("n_series"))
    )


def automation_rate(audit: DataFrame) -> DataFrame:
    """Share of created orders that no person approved, per store."""
    created = audit.filter(F.col("bapi_status") == "ok")
    return (
        created.groupBy("werks")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.count_if(~F.col("approval_status").isin(*MANUAL)).alias("n_automatic"),
        )
        .withColumn("automation_rate", F.col("n_automatic") / F.col("n_orders"))
    )


def days_of_inventory(
    positions: DataFrame, velocity: DataFrame, master: DataFrame, days: int = 28
) -> DataFrame:
    """Stock value over mean daily cost of sales, per category; NULL without sales."""
    cost = F.col("unit_cost").cast("decimal(18,6)")
    stock = positions.select(*KEYS, "stock_qty")
    sales = velocity.groupBy(*KEYS).agg(F.sum(f"sales_{days}d").alias("sold"))
    totals = (
        master.select(*KEYS, "category", "unit_cost")
        .join(stock, KEYS, "inner")
        .join(sales, KEYS, "left")
        .groupBy("category")
        .agg(
            F.sum(F.col("stock_qty") * cost).cast("double").alias("stock_value"),
            (F.sum(F.coalesce("sold", F.lit(0)) * cost).cast("double") / days).alias(
                "daily_cost_of_sales"
            ),
        )
    )
    return totals.withColumn(
        "days_of_inventory",
        F.when(
            F.col("daily_cost_of_sales") != 0,
            F.col("stock_value") / F.col("daily_cost_of_sales"),
        ),
    )


def week_start(day: str) -> Column:
    """Monday of the week of a day."""
    return F.date_trunc("week", F.col(day)).cast("date")


def weekly_actuals(movements: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Quantity sold per site, SKU and week (named by its Monday)."""
    item = "unified_sku_id" if registry is None else "MATNR"
    sold = (
        movements.filter(F.col("BWART") == config.SALE)
        .groupBy("WERKS", item, week_start("BUDAT").alias("week"))
        .agg(F.sum("MENGE").alias("actual"))
    )
    return (
        attach_sku(sold, registry)
        .groupBy(F.col("WERKS").alias("werks"), "unified_sku_id", "week")
        .agg(F.sum("actual").cast("double").alias("actual"))
    )
