"""Silver layer: cleaned feeds, the SKU registry and enriched movements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder import config
from larder.functions.grouping import latest_per_key


def clean_materials(materials: DataFrame) -> DataFrame:
    """Newest record of every stocked material."""
    stocked = materials.filter(
        F.col("MATNR").isNotNull() & F.col("MTART").isin(*config.MATERIAL_TYPES)
    )
    return latest_per_key(stocked, ["MATNR"], ["LAEDA"]).withColumns(
        {c: F.col(c).cast("int") for c in ("MHDRZ", "MHDLP")}
    )


def clean_inventory(movements: DataFrame) -> DataFrame:
    """Newest version of every document line with a stock or sales movement type."""
    relevant = movements.filter(
        F.col("MBLNR").isNotNull()
        & F.col("ZEILE").isNotNull()
        & F.col("BWART").isin(*config.MOVEMENT_TYPES)
    )
    newest = ["CPUDT"] + [c for c in ("CPUTM",) if c in movements.columns]
    return latest_per_key(relevant, ["MBLNR", "ZEILE"], newest).withColumns(
        {c: F.col(c).cast("date") for c in ("BUDAT", "CPUDT")}
    )


def clean_open_orders(orders: DataFrame) -> DataFrame:
    """Newest version of every order line with a positive quantity."""
    live = orders.filter(
        F.col("EBELN").isNotNull() & F.col("EBELP").isNotNull() & (F.col("MENGE") > 0)
    )
    return latest_per_key(live, ["EBELN", "EBELP"], ["BEDAT"]).withColumns(
        {c: F.col(c).cast("date") for c in ("EINDT", "BEDAT")}
    )


def sku_registry(materials: DataFrame, source_banner: str) -> DataFrame:
    """One identity per material: its barcode, or a synthetic id where it has none."""
    has_barcode = F.col("EAN11").isNotNull()
    return latest_per_key(materials, ["MATNR"], ["LAEDA"]).select(
        F.coalesce("EAN11", F.concat(F.lit("MATNR-"), F.col("MATNR"))).alias("unified_sku_id"),
        F.col("MATNR").alias("sap_material_number"),
        F.col("EAN11").alias("ean_barcode"),
        F.col("MAKTX").alias("material_description"),
        F.col("MTART").alias("material_type"),
        F.col("MATKL").alias("material_group"),
        F.col("MEINS").alias("base_uom"),
        F.col("MHDRZ").alias("shelf_life_days"),
        F.col("MHDLP").alias("min_remaining_shelf_life"),
        has_barcode.cast("double").alias("match_confidence"),
        F.lit(source_banner).alias("source_banner"),
    )


def match_rate(registry: DataFrame, *codes: str) -> DataFrame:
    """Share of registry rows where all ``codes`` (default: the barcode) are present."""
    present = F.lit(True)
    for code in codes or ("ean_barcode",):
        present = present & F.col(code).isNotNull()
    return registry.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(present).alias("n_matched"),
    ).withColumn(
        "match_rate",
        F.when(F.col("n_rows") > 0, F.col("n_matched") / F.col("n_rows")).otherwise(F.lit(0.0)),
    )


def registry_ready(
    registry: DataFrame, *codes: str, gate: float = config.IdentityLimits().match_rate_gate
) -> DataFrame:
    """The match rate and whether model training may start."""
    return match_rate(registry, *codes).withColumn("is_ready", F.col("match_rate") >= gate)


def lookup_by_sap(registry: DataFrame, sap_material_number: str) -> DataFrame:
    """Registry rows of one material."""
    return registry.filter(F.col("sap_material_number") == F.lit(sap_material_number))


def material_dimension(materials: DataFrame, registry: DataFrame) -> DataFrame:
    """What is known of a material from either table, one row per material."""
    described = materials.select(
        "MATNR",
        F.col("MAKTX").alias("material_description"),
        F.col("MTART").alias("material_type"),
        F.col("MHDRZ").alias("shelf_life_days"),
    )
    identified = registry.select(
        F.col("sap_material_number").alias("MATNR"), "unified_sku_id", "match_confidence"
    )
    return described.join(identified, "MATNR", "full")


def enriched_movements(inventory: DataFrame, dimension: DataFrame) -> DataFrame:
    """Movements with material and identity columns; movements without a match are kept.

    The movements are joined once, so they are shuffled at most once. Pass the dimension as
    a table: Spark then shuffles both sides for this join alone and can split a hot material.
    """
    return inventory.join(dimension, "MATNR", "left")


def confidence_filter(df: DataFrame) -> DataFrame:
    """Rows whose identity rests on a barcode, the only ones used for training."""
    return df.filter(F.col("match_confidence") == 1.0)
