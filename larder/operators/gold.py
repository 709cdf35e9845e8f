"""Gold layer: stock positions, sales velocity and open orders per site and SKU.

Sums run per material before the SKU identity is joined. A hot material shrinks on the map
side, and the join only sees one row per site, material and unit (and day where needed).
Input that already carries ``unified_sku_id`` is summed directly when no registry is given.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder import config
from larder.functions.quantities import QUANTITY, sale_quantity, signed_quantity


def _item_column(registry: DataFrame | None) -> str:
    return "unified_sku_id" if registry is None else "MATNR"


def attach_sku(per_material: DataFrame, registry: DataFrame | None) -> DataFrame:
    """Adds the SKU of a material; unknown materials keep a NULL SKU."""
    if registry is None:
        return per_material
    identity = registry.select(F.col("sap_material_number").alias("MATNR"), "unified_sku_id")
    return per_material.join(identity, "MATNR", "left").drop("MATNR")


def day_literal(day: dt.date | Column) -> Column:
    return day if isinstance(day, Column) else F.lit(day)


def daily_net(movements: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Net stock change per site, SKU, unit and day."""
    item = _item_column(registry)
    by_item = movements.groupBy("WERKS", item, "BUDAT", "MEINS").agg(
        F.sum(signed_quantity()).alias("net")
    )
    if registry is None:
        return by_item
    return (
        attach_sku(by_item, registry)
        .groupBy("WERKS", "unified_sku_id", "BUDAT", "MEINS")
        .agg(F.sum("net").alias("net"))
    )


def position_history(movements: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Stock after every day with a movement.

    The running sum follows (day, unit) inside a site and SKU, one row per day and unit.
    """
    so_far = (
        Window.partitionBy("WERKS", "unified_sku_id")
        .orderBy("BUDAT", "MEINS")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily_net(movements, registry).select(
        F.col("WERKS").alias("werks"),
        "unified_sku_id",
        F.col("BUDAT").alias("snapshot_date"),
        F.sum("net").over(so_far).cast(QUANTITY).alias("stock_qty"),
        F.col("MEINS").alias("uom"),
    )


def movement_rollup(
    movements: DataFrame, reference_date: dt.date | Column, registry: DataFrame | None = None
) -> DataFrame:
    """Stock, sales windows and last sale per site, SKU and unit, in one pass.

    Positions, velocity and last sale are all cut from this table, so writing it once means
    reading the movements once. The sales windows end at the reference date and have no
    upper bound; pass movements up to the date for a past day.
    """
    item = _item_column(registry)
    ref = day_literal(reference_date)
    is_sale = F.col("BWART").isin(config.SALE, config.SALE_RETURN)
    windows = {f"sales_{n}d": n for n in config.SALES_WINDOWS}
    rollup = movements.groupBy("WERKS", item, "MEINS").agg(
        F.sum(signed_quantity()).alias("net"),
        F.max("BUDAT").alias("last_day"),
        *[
            F.sum(F.when(F.col("BUDAT") >= F.date_sub(ref, n), sale_quantity())).alias(c)
            for c, n in windows.items()
        ],
        F.count_if(is_sale).alias("n_sales"),
        F.max(F.when(F.col("BWART") == config.SALE, F.col("BUDAT"))).alias("last_sale_date"),
    )
    if registry is not None:
        rollup = (
            attach_sku(rollup, registry)
            .groupBy("WERKS", "unified_sku_id", "MEINS")
            .agg(
                F.sum("net").alias("net"),
                F.max("last_day").alias("last_day"),
                *[F.sum(c).alias(c) for c in windows],
                F.sum("n_sales").alias("n_sales"),
                F.max("last_sale_date").alias("last_sale_date"),
            )
        )
    return rollup.select(
        F.col("WERKS").alias("werks"),
        "unified_sku_id",
        F.col("MEINS").alias("uom"),
        F.col("net").cast(QUANTITY).alias("net"),
        "last_day",
        *[F.coalesce(F.col(c), F.lit(0)).cast(QUANTITY).alias(c) for c in windows],
        "n_sales",
        "last_sale_date",
    )


def positions_of(rollup: DataFrame) -> DataFrame:
    """Present stock per site and SKU, dated and measured like its last movement."""
    return (
        rollup.groupBy("werks", "unified_sku_id")
        .agg(
            F.sum("net").cast(QUANTITY).alias("stock_qty"),
            F.max(F.struct("last_day", "uom")).alias("_last"),
        )
        .select(
            "werks",
            "unified_sku_id",
            F.col("_last.last_day").alias("snapshot_date"),
            "stock_qty",
            F.col("_last.uom").alias("uom"),
        )
    )


def velocity_of(rollup: DataFrame) -> DataFrame:
    """Sales windows of every site, SKU and unit that ever sold or took back."""
    return rollup.filter(F.col("n_sales") > 0).select(
        "werks", "unified_sku_id", *[f"sales_{n}d" for n in config.SALES_WINDOWS], "uom"
    )


def last_sale_of(rollup: DataFrame, reference_date: dt.date | Column) -> DataFrame:
    """Day of the last sale and the days since, per site and SKU."""
    return (
        rollup.filter(F.col("last_sale_date").isNotNull())
        .groupBy("werks", "unified_sku_id")
        .agg(F.max("last_sale_date").alias("last_sale_date"))
        .withColumn(
            "days_since_last_sale", F.datediff(day_literal(reference_date), "last_sale_date")
        )
    )


def daily_positions(movements: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Last row of the position history, one per site and SKU.

    The last running sum is the plain sum, so no ordering of days is needed.
    """
    return positions_of(movement_rollup(movements, dt.date.max, registry))


def _only(movements: DataFrame, *codes: str) -> DataFrame:
    return movements.filter(F.col("BWART").isin(*codes))


def sales_velocity(
    movements: DataFrame, reference_date: dt.date | Column, registry: DataFrame | None = None
) -> DataFrame:
    """Net sales over four windows; only sales and returns leave the scan."""
    sales = _only(movements, config.SALE, config.SALE_RETURN)
    return velocity_of(movement_rollup(sales, reference_date, registry))


def last_sale(
    movements: DataFrame, reference_date: dt.date | Column, registry: DataFrame | None = None
) -> DataFrame:
    """Day of the last sale and the days since; only sales leave the scan."""
    sales = _only(movements, config.SALE)
    return last_sale_of(movement_rollup(sales, reference_date, registry), reference_date)


def open_orders(
    orders: DataFrame, reference_date: dt.date | Column, registry: DataFrame | None = None
) -> DataFrame:
    """Quantity still to come and its first delivery day per site, SKU and unit."""
    item = _item_column(registry)
    merged = (
        orders.filter(F.col("EINDT") >= day_literal(reference_date))
        .groupBy("WERKS", item, "MEINS")
        .agg(F.sum("MENGE").alias("qty"), F.min("EINDT").alias("first_day"))
    )
    if registry is not None:
        merged = (
            attach_sku(merged, registry)
            .groupBy("WERKS", "unified_sku_id", "MEINS")
            .agg(F.sum("qty").alias("qty"), F.min("first_day").alias("first_day"))
        )
    return merged.select(
        F.col("WERKS").alias("werks"),
        "unified_sku_id",
        F.col("qty").cast(QUANTITY).alias("open_qty"),
        F.col("first_day").alias("earliest_delivery"),
        F.col("MEINS").alias("uom"),
    )
