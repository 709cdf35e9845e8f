"""Feature tables per site and SKU."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder import config
from larder.functions.quantities import QUANTITY, guarded_ratio

KEYS = list(config.KEYS)


def sales_per_key(
    velocity: DataFrame, windows: Sequence[int] = config.SALES_WINDOWS, unit: bool = False
) -> DataFrame:
    """One row per site and SKU: sales of several units are added up, the first unit may be named."""
    return velocity.groupBy(*KEYS).agg(
        *[F.sum(f"sales_{n}d").cast(QUANTITY).alias(f"sales_{n}d") for n in windows],
        *([F.min("uom").alias("uom")] if unit else []),
    )


def velocity_features(velocity: DataFrame) -> DataFrame:
    """Sales windows per site and SKU in their canonical types."""
    return sales_per_key(velocity, unit=True).select(
        *KEYS,
        *[F.col(f"sales_{n}d").cast(QUANTITY) for n in config.SALES_WINDOWS],
        "uom",
    )


def stock_features(positions: DataFrame, velocity: DataFrame) -> DataFrame:
    """Stock and how many days it lasts at last week's rate.

    Cover is NULL without sales in the week, and where it does not fit its type.
    """
    week = sales_per_key(velocity, (7,))
    cover = guarded_ratio(F.col("stock_qty"), F.col("sales_7d") / 7).try_cast("decimal(8,2)")
    return positions.join(week, KEYS, "left").select(
        *KEYS,
        F.col("stock_qty").cast(QUANTITY),
        cover.alias("days_of_cover"),
        "uom",
    )


def shelf_life_by_sku(registry: DataFrame) -> DataFrame:
    """One shelf life per SKU; materials that share a barcode would otherwise fan out joins."""
    return registry.groupBy("unified_sku_id").agg(
        F.min_by(F.col("shelf_life_days").cast("int"), "sap_material_number").alias(
            "shelf_life_days"
        )
    )


def collapse_signals(
    velocity: DataFrame, last_sales: DataFrame, registry: DataFrame
) -> DataFrame:
    """Signs of sales that stopped: week against month, days since the last sale."""
    ratio = guarded_ratio(F.col("sales_7d"), F.col("sales_28d")).cast("double")
    return (
        sales_per_key(velocity, (7, 28))
        .withColumn("velocity_collapse_ratio", ratio)
        .join(last_sales.select(*KEYS, "days_since_last_sale"), KEYS, "left")
        .join(shelf_life_by_sku(registry), "unified_sku_id", "left")
        .select(*KEYS, "velocity_collapse_ratio", "days_since_last_sale", "shelf_life_days")
    )


def feature_vector(velocity: DataFrame, stock: DataFrame, collapse: DataFrame) -> DataFrame:
    """The three feature tables side by side; only keys present in all of them."""
    return (
        velocity.drop("_computed_at")
        .join(stock.drop("uom", "_computed_at"), KEYS, "inner")
        .join(collapse.drop("_computed_at"), KEYS, "inner")
    )


def sales_moving_averages(
    daily_sales: DataFrame, days: tuple[int, ...] = (7, 14, 30)
) -> DataFrame:
    """Mean sales per calendar day over the last n days, for every day with a sale.

    Days without a sale count as zero: the window sum is divided by n.
    """
    day_number = F.datediff("ds", F.lit(dt.date(1970, 1, 1)))
    per_key = Window.partitionBy(*KEYS).orderBy("_day")
    return (
        daily_sales.withColumn("_day", day_number)
        .withColumns(
            {
                f"avg_{n}d": F.sum("y").over(per_key.rangeBetween(-(n - 1), 0)).cast("double") / n
                for n in days
            }
        )
        .drop("_day")
    )
