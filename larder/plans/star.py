"""Maps a star-schema data set (orders, line items, parts, suppliers, events, documents) onto
the shapes of the replenishment feeds, so every operator can run on any such data set.

A site is the region of a supplier, a material is a part, a document line is a line item.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import config
from larder.operators import demand as demand_ops
from larder.operators import features as feature_ops
from larder.operators import edi, gold, ordering, phantom, review, silver, sweep
from larder.session import remove_folder, work_dir
from larder.sources.feeds import FEEDS, conform

REFERENCE_DATE = dt.date(1999, 6, 30)
BANNER = "HOME_NL"
SENDER = "BUYER_NL"
EDI_TIMESTAMP = "19990630081000"
LOADED_AT = "1999-06-30T08:05:00Z"
KEYS = list(config.KEYS)
_PUBLISHED: dict[tuple, tuple] = {}


# Schemas of the star tables that are used
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A star table; the schema is given, so no job runs to read it from the files."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _padded(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def material_number(part: str) -> Column:
    return F.concat(F.lit("MAT"), _padded(F.col(part), 8))


def barcode(part: str) -> Column:
    """Parts have a barcode, every 25th has none."""
    return F.when(F.col(part) % 25 != 0, F.concat(F.lit("87"), _padded(F.col(part), 11)))


def sku(part: str) -> Column:
    return F.coalesce(barcode(part), F.concat(F.lit("MATNR-"), material_number(part)))


def site(region: str) -> Column:
    return F.concat(F.lit("NL"), _padded(F.col(region), 2))


class Star:
    """Feed-shaped views of one data folder, each built on first use."""

    def __init__(self, spark: SparkSession, folder: str, reference_date: dt.date = REFERENCE_DATE):
        self.spark = spark
        self.folder = folder
        self.reference_date = reference_date

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)

    @cached_property
    def content(self) -> tuple:
        """Path, size and time of every file of the tables, so a replaced table is seen."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.folder)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = []
        for name in SCHEMAS:
            path = jvm.org.apache.hadoop.fs.Path(root, f"{name}.parquet")
            if files.exists(path):
                found += [
                    (f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files.listStatus(path)
                ]
        return tuple(found)

    def published(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Hands rows over through a table in the shared folder, written once per state of the tables.

        Layers read each other's tables: a plan several steps need runs once, and a lost
        executor costs a re-read instead of a rebuild.
        """
        key = (self.spark.sparkContext.applicationId, self.content, self.reference_date, name)
        if key not in _PUBLISHED:
            path, df = work_dir(self.spark, name), build()
            df.write.parquet(path)
            _PUBLISHED[key] = (path, df.schema)
        path, schema = _PUBLISHED[key]
        return self.spark.read.schema(schema).parquet(path)

    def model(self, name: str, train: Callable[[], PipelineModel]) -> PipelineModel:
        """A trained model, saved in the shared folder once per session."""
        key = (self.spark.sparkContext.applicationId, self.content, self.reference_date, name)
        if key not in _PUBLISHED:
            path = work_dir(self.spark, name)
            train().write().save(path)
            _PUBLISHED[key] = (path, None)
        return PipelineModel.load(_PUBLISHED[key][0])

    @staticmethod
    def clear(spark: SparkSession) -> None:
        """Removes the published tables and models of the session, for its end."""
        mine = [k for k in _PUBLISHED if k[0] == spark.sparkContext.applicationId]
        for key in mine:
            remove_folder(spark, _PUBLISHED.pop(key)[0])

    # ---- raw feeds ---------------------------------------------------------------

    @cached_property
    def current_materials(self) -> DataFrame:
        kind = (
            F.when(F.col("p_type") == "PROMO", "DIEN")
            .when(F.col("p_type") == "ECONOMY", "HALB")
            .when(F.col("p_type") == "LARGE", "ROH")
            .otherwise("FERT")
        )
        rows = self.table("part").select(
            material_number("p_partkey").alias("MATNR"),
            barcode("p_partkey").alias("EAN11"),
            F.concat(F.lit("NL0"), (F.col("p_size") % 5).cast("string")).alias("WERKS"),
            F.col("p_name").alias("MAKTX"),
            kind.alias("MTART"),
            F.col("p_brand").alias("MATKL"),
            F.lit("EA").alias("MEINS"),
            (2 + F.col("p_size") % 12).alias("MHDRZ"),
            F.lit("D").alias("IPRKZ"),
            (1 + F.col("p_size") % 3).alias("MHDLP"),
            F.date_add(F.lit(dt.date(1998, 1, 1)), (F.col("p_partkey") % 300).cast("int")).alias(
                "LAEDA"
            ),
            F.lit(dt.date(1996, 1, 1)).alias("ERSDA"),
        )
        return conform(rows, FEEDS["materials"])

    @cached_property
    def older_materials(self) -> DataFrame:
        """An earlier version of every material, before it had a barcode."""
        rows = self.current_materials.withColumns(
            {
                "MAKTX": F.concat(F.lit("old "), F.col("MAKTX")),
                "MHDLP": F.lit(1),
                "LAEDA": F.lit(dt.date(1997, 1, 1)),
            }
        ).drop("EAN11")
        return conform(rows, FEEDS["materials"])

    @cached_property
    def raw_materials(self) -> DataFrame:
        return self.current_materials.unionByName(self.older_materials)

    @cached_property
    def _supplier_sites(self) -> DataFrame:
        """Suppliers with their region, as a table.

        The size of a join is estimated as the product of its sides, so the line items would be
        shuffled to meet a few rows; the size of a table is known, and Spark picks by it.
        """
        return self.published("supplier_sites", self.build_supplier_sites)

    def build_supplier_sites(self) -> DataFrame:
        nation = self.table("nation").select(
            F.col("n_nationkey").alias("s_nationkey"), "n_regionkey"
        )
        return (
            self.table("supplier")
            .join(nation, "s_nationkey", "inner")
            .select(F.col("s_suppkey").alias("l_suppkey"), "s_acctbal", "n_regionkey")
        )

    @cached_property
    def lines(self) -> DataFrame:
        return self.table("lineitem").join(self._supplier_sites, "l_suppkey", "inner")

    def movements_of(self, lines: DataFrame) -> DataFrame:
        """Line items (batch or stream) as goods movements."""
        number, flag = F.col("l_linenumber"), F.col("l_returnflag")
        code = (
            F.when(number == 1, "101")
            .when((number == 2) & (flag == "R"), "102")
            .when((number == 3) & (flag == "R"), "262")
            .when((number == 3) & (flag == "A"), "261")
            .when((number == 7) & (F.col("l_tax") == 0.08), "999")
            .when((flag == "R") & (F.col("l_linestatus") == "F"), "602")
            .otherwise("601")
        )
        day = F.col("l_shipdate").cast("date")
        rows = lines.select(
            F.concat(F.lit("D"), F.col("l_orderkey").cast("string")).alias("MBLNR"),
            _padded(number, 4).alias("ZEILE"),
            material_number("l_partkey").alias("MATNR"),
            site("n_regionkey").alias("WERKS"),
            F.lit("0001").alias("LGORT"),
            code.alias("BWART"),
            (F.col("l_quantity") * F.when(number == 1, 8).otherwise(1)).alias("MENGE"),
            F.when((F.col("l_partkey") % 10 == 3) & (number == 4), "KG").otherwise("EA").alias("MEINS"),
            day.alias("BUDAT"),
            day.alias("CPUDT"),
            (
                F.col("l_shipdate").cast("timestamp_ntz")
                + F.make_dt_interval(secs=(F.col("l_partkey") % 86400).cast("decimal(18,6)"))
            ).alias("CPUTM"),
        )
        return conform(rows, FEEDS["inventory"])

    @cached_property
    def raw_movements(self) -> DataFrame:
        return self.movements_of(self.lines)

    @cached_property
    def raw_open_orders(self) -> DataFrame:
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"
        )
        rows = self.lines.join(orders, "l_orderkey", "inner").select(
            F.concat(F.lit("E"), F.col("l_orderkey").cast("string")).alias("EBELN"),
            _padded(F.col("l_linenumber"), 5).alias("EBELP"),
            material_number("l_partkey").alias("MATNR"),
            site("n_regionkey").alias("WERKS"),
            F.concat(F.lit("V"), _padded(F.col("l_suppkey"), 6)).alias("LIFNR"),
            F.when(F.col("l_discount") == 0, 0.0).otherwise(F.col("l_quantity")).alias("MENGE"),
            F.lit("EA").alias("MEINS"),
            F.col("l_extendedprice").alias("NETPR"),
            F.lit("EUR").alias("WAERS"),
            F.col("l_shipdate").cast("date").alias("EINDT"),
            F.col("o_orderdate").cast("date").alias("BEDAT"),
            F.lit("NL01").alias("EKORG"),
            F.lit("001").alias("EKGRP"),
        )
        return conform(rows, FEEDS["open_orders"])

    # ---- silver ------------------------------------------------------------------

    @cached_property
    def materials(self) -> DataFrame:
        return self.published(
            "materials_clean", lambda: silver.clean_materials(self.raw_materials)
        )

    @cached_property
    def inventory(self) -> DataFrame:
        return self.published(
            "inventory_clean", lambda: silver.clean_inventory(self.raw_movements)
        )

    @cached_property
    def movements(self) -> DataFrame:
        """Clean movements up to the reference date."""
        return self.inventory.filter(F.col("BUDAT") <= F.lit(self.reference_date))

    @cached_property
    def orders(self) -> DataFrame:
        return self.published(
            "open_orders_clean", lambda: silver.clean_open_orders(self.raw_open_orders)
        )

    @cached_property
    def registry(self) -> DataFrame:
        return self.published(
            "sku_registry", lambda: silver.sku_registry(self.raw_materials, BANNER)
        )

    @cached_property
    def dimension(self) -> DataFrame:
        return self.published(
            "material_dimension",
            lambda: silver.material_dimension(self.materials, self.registry),
        )

    @cached_property
    def kinds(self) -> DataFrame:
        """Material to material type, in registry form: such series hold a year of days with sales."""
        return self.materials.select(
            F.col("MATNR").alias("sap_material_number"), F.col("MTART").alias("unified_sku_id")
        )

    # ---- gold and features ---------------------------------------------------------

    @cached_property
    def rollup(self) -> DataFrame:
        """Movement rollup as a table: every feature and label is cut from it."""
        return self.published(
            "movement_rollup",
            lambda: gold.movement_rollup(self.movements, self.reference_date, self.registry),
        )

    @cached_property
    def positions(self) -> DataFrame:
        return gold.positions_of(self.rollup)

    @cached_property
    def velocity(self) -> DataFrame:
        return gold.velocity_of(self.rollup)

    @cached_property
    def stock_features(self) -> DataFrame:
        return feature_ops.stock_features(self.positions, self.velocity)

    @cached_property
    def last_sales(self) -> DataFrame:
        return gold.last_sale_of(self.rollup, self.reference_date)

    @cached_property
    def collapse(self) -> DataFrame:
        return feature_ops.collapse_signals(self.velocity, self.last_sales, self.registry)

    @cached_property
    def features(self) -> DataFrame:
        return self.published("features", self.build_features)

    def build_features(self) -> DataFrame:
        return feature_ops.feature_vector(
            feature_ops.velocity_features(self.velocity), self.stock_features, self.collapse
        )

    # ---- phantom stock -------------------------------------------------------------

    @cached_property
    def labels(self) -> DataFrame:
        return phantom.phantom_labels(self.positions, self.velocity, self.reference_date)

    @cached_property
    def given_scores(self) -> DataFrame:
        """A score from stock and sales alone, for the steps after the model."""
        stock = F.col("stock_qty").cast("double")
        month = F.abs(F.col("sales_28d").cast("double"))
        return phantom.phantom_banding(
            self.features.select(
                *KEYS,
                F.when(stock > 0, stock / (stock + month)).otherwise(0.0).alias("phantom_score"),
                "shelf_life_days",
                "stock_qty",
            )
        )

    @cached_property
    def alerts(self) -> DataFrame:
        return phantom.phantom_alerts(self.given_scores)

    # ---- demand --------------------------------------------------------------------

    @cached_property
    def series(self) -> DataFrame:
        """Daily demand by site and material type."""
        return self.published(
            "kind_demand",
            lambda: demand_ops.daily_demand(self.movements, self.reference_date, self.kinds),
        )

    def build_series(self) -> DataFrame:
        """Daily demand by site and SKU."""
        return demand_ops.daily_demand(self.movements, self.reference_date, self.registry)

    @cached_property
    def series_stock(self) -> DataFrame:
        rollup = self.published(
            "kind_rollup",
            lambda: gold.movement_rollup(self.movements, self.reference_date, self.kinds),
        )
        return feature_ops.stock_features(gold.positions_of(rollup), gold.velocity_of(rollup))

    @cached_property
    def kind_categories(self) -> DataFrame:
        """Every SKU and every material type that moved at a site, under its material type."""
        moved = self.movements.select("WERKS", "MATNR").distinct().join(
            self.kinds.select(F.col("sap_material_number").alias("MATNR"), F.col("unified_sku_id").alias("category")),
            "MATNR",
        )
        names = self.registry.select(F.col("sap_material_number").alias("MATNR"), "unified_sku_id")
        by_sku = moved.join(names, "MATNR").select(F.col("WERKS").alias("werks"), "unified_sku_id", "category")
        by_kind = moved.select(F.col("WERKS").alias("werks"), F.col("category").alias("unified_sku_id"), "category")
        return by_sku.unionByName(by_kind).distinct()

    @cached_property
    def kind_forecasts(self) -> DataFrame:
        """Last month's sales of a material type spread over the horizons."""
        rollup = self.published(
            "kind_rollup", lambda: gold.movement_rollup(self.movements, self.reference_date, self.kinds)
        )
        month = F.col("sales_28d").cast("double")
        return demand_ops.clip_forecasts(
            feature_ops.sales_per_key(gold.velocity_of(rollup)).select(
                *KEYS, *[(month * h / 28).alias(f"raw_{h}d") for h in config.HORIZONS]
            )
        )

    @cached_property
    def given_forecasts(self) -> DataFrame:
        """Last month's sales spread over the horizons, for the steps after the model."""
        month = F.col("sales_28d").cast("double")
        return demand_ops.clip_forecasts(
            feature_ops.sales_per_key(self.velocity).select(
                *KEYS, *[(month * h / 28).alias(f"raw_{h}d") for h in config.HORIZONS]
            )
        )

    @cached_property
    def recent(self) -> DataFrame:
        return self.published(
            "actuals",
            lambda: demand_ops.recent_sales(self.movements, self.reference_date, 7, self.registry),
        )

    @cached_property
    def promo_calendar(self) -> DataFrame:
        """One promotion per site, SKU and discount step, with the mean quantity sold in it."""
        return (
            self.lines.filter(F.col("l_discount") >= 0.05)
            .groupBy("n_regionkey", "l_partkey", "l_discount")
            .agg(
                F.sum("l_quantity").alias("q"),
                F.count(F.lit(1)).alias("n"),
            )
            .select(
                site("n_regionkey").alias("werks"),
                sku("l_partkey").alias("unified_sku_id"),
                (F.col("q") / F.col("n")).alias("baseline_demand"),
            )
        )

    @cached_property
    def promo(self) -> DataFrame:
        return demand_ops.promo_lift(self.given_forecasts, self.recent, self.promo_calendar)

    @cached_property
    def corrected(self) -> DataFrame:
        return demand_ops.m2_corrected(self.given_forecasts, self.promo, F.lit(1.25))

    @cached_property
    def stored_corrected(self) -> DataFrame:
        return self.published("m2_corrected", lambda: self.corrected)

    @cached_property
    def residuals(self) -> DataFrame:
        return demand_ops.m2_residuals(self.stored_corrected, self.recent)

    @cached_property
    def weather_bodies(self) -> DataFrame:
        """One forecast body per event: the event day and the two days after it."""
        start = F.col("ts").cast("date")
        days = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.date_add(start, i).cast("string"))
        warm = F.transform(
            F.sequence(F.lit(0), F.lit(2)),
            lambda i: F.when(~((F.col("event_type") == "error") & (i == 2)), F.col("value") + i),
        )
        rain = F.transform(
            F.sequence(F.lit(0), F.lit(2)),
            lambda i: F.when(~((F.col("event_type") == "view") & (i == 1)), F.col("value") * i),
        )
        daily = F.struct(
            days.alias("time"),
            warm.alias("temperature_2m_max"),
            rain.alias("precipitation_sum"),
        )
        return self.table("events").select(
            "event_id",
            F.to_json(F.struct(daily.alias("daily")), {"ignoreNullFields": "false"}).alias("body"),
        )

    @cached_property
    def weather(self) -> DataFrame:
        """Daily weather from events: warmest value, rain from purchases (none on other days)."""
        amount = F.col("value").cast("decimal(12,2)")
        return (
            self.table("events")
            .groupBy(F.col("ts").cast("date").alias("forecast_date"))
            .agg(
                (F.max(amount).cast("double") / 20).alias("temperature_max"),
                (
                    F.sum(F.when(F.col("event_type") == "purchase", amount)).cast("double") / 1000
                ).alias("precipitation"),
            )
        )

    # ---- ordering ------------------------------------------------------------------

    @cached_property
    def _site_parts(self) -> DataFrame:
        """Per site and part: quantity sold and received, and the smallest solvent supplier."""
        number, flag = F.col("l_linenumber"), F.col("l_returnflag")
        return self.lines.groupBy("n_regionkey", "l_partkey").agg(
            F.coalesce(
                F.sum(F.when((number != 1) & (flag != "R"), F.col("l_quantity"))), F.lit(0.0)
            ).alias("sold"),
            F.coalesce(F.sum(F.when(number == 1, F.col("l_quantity"))), F.lit(0.0)).alias(
                "received"
            ),
            F.min(F.when(F.col("s_acctbal") >= 0, F.col("l_suppkey"))).alias("vendor"),
        )

    @cached_property
    def _site_part_attributes(self) -> DataFrame:
        part = self.table("part").withColumnRenamed("p_partkey", "l_partkey")
        return self.published(
            "site_parts",
            lambda: self._site_parts.join(part, "l_partkey", "inner").withColumns(
                {"werks": site("n_regionkey"), "unified_sku_id": sku("l_partkey")}
            ),
        )

    @cached_property
    def master(self) -> DataFrame:
        """Order parameters per site and SKU."""
        key, size, kind = F.col("l_partkey"), F.col("p_size"), F.col("p_type")
        category = (
            F.when(kind.isin("SMALL", "MEDIUM"), "FRESH_PRODUCE")
            .when(kind.isin("LARGE", "STANDARD"), "BAKERY")
            .otherwise("DRY")
        )
        return self._site_part_attributes.select(
            *KEYS,
            category.alias("category"),
            (2 + size % 12).cast("int").alias("shelf_life_days"),
            (1 + key % 6).cast("int").alias("transit_days"),
            (1 + key % 5).cast("int").alias("min_order_qty"),
            (40 + key % 160).cast("int").alias("max_order_qty"),
            (15 + key % 200).cast("double").alias("truck_capacity_units"),
            (F.col("p_retailprice") / 100).alias("unit_cost"),
            barcode("l_partkey").alias("ean_barcode"),
            F.concat(F.lit("V"), _padded(F.col("vendor"), 6)).alias("vendor_id"),
        )

    @cached_property
    def quantiles(self) -> DataFrame:
        """Demand quantiles from past sales, so ordering has known inputs."""
        median = F.col("sold") / 4
        widen = 1 + 0.05 * (F.col("l_partkey") % 8)
        return self._site_part_attributes.select(
            *KEYS,
            (0.9 * median).alias("p10"),
            median.alias("p50"),
            (median * widen).alias("p90"),
            (median * widen - 0.9 * median).alias("uncertainty_spread"),
        )

    @cached_property
    def lifts(self) -> DataFrame:
        return self._site_part_attributes.select(
            *KEYS,
            (1 + (F.col("p_size") % 4) / 4).alias("promo_lift"),
            F.lit(1.25).alias("weather_lift"),
        )

    @cached_property
    def order_stock(self) -> DataFrame:
        return self._site_part_attributes.select(*KEYS, (F.col("received") / 10).alias("stock_qty"))

    @cached_property
    def solver_inputs(self) -> DataFrame:
        return ordering.solver_inputs(self.quantiles, self.lifts, self.order_stock, self.master)

    @cached_property
    def solver_output(self) -> DataFrame:
        return ordering.solver_output(self.solver_inputs)

    @cached_property
    def recommendations(self) -> DataFrame:
        return ordering.order_recommendations(self.solver_output, self.quantiles)

    @cached_property
    def stored_recommendations(self) -> DataFrame:
        """The recommendations as the table orders, review and finalisation read."""
        return self.published("order_recommendations", lambda: self.recommendations)

    @cached_property
    def candidates(self) -> DataFrame:
        return ordering.po_candidates(self.stored_recommendations)

    def responses(self, rows: DataFrame) -> DataFrame:
        """A response per order: numbers under three names, refusals, and answers that are
        missing, empty or not readable."""
        number = F.concat(F.lit("45"), F.substring(F.col("unified_sku_id"), -8, 8))
        failed = F.col("recommended_qty") % 10 == 9
        odd = F.col("recommended_qty") % 50
        ok = F.lit('"RETURN":[{"TYPE":"S","MESSAGE":"created"}]}')
        body = (
            F.when(odd == 18, F.lit(None).cast("string"))
            .when(odd == 28, "<html>busy</html>")
            .when(odd == 38, "")
            .when(
                failed,
                F.lit('{"RETURN":[{"TYPE":"W","MESSAGE":"late"},{"TYPE":"E","MESSAGE":"refused"}]}'),
            )
            .when(F.col("werks") == "NL00", F.concat(F.lit('{"PO_NUMBER":"'), number, F.lit('",'), ok))
            .when(
                F.col("werks") == "NL01",
                F.concat(F.lit('{"EXPPURCHASEORDER":"'), number, F.lit('",'), ok),
            )
            .otherwise(F.concat(F.lit('{"POHDR":{"EBELN":"'), number, F.lit('"},'), ok))
        )
        return rows.select(*KEYS, body.alias("response"))

    @cached_property
    def order_confirmations(self) -> DataFrame:
        return ordering.po_confirmations(self.responses(self.candidates))

    @cached_property
    def order_audit(self) -> DataFrame:
        return ordering.po_audit(ordering.po_requests(self.candidates), self.order_confirmations)

    # ---- sweep and review ------------------------------------------------------------

    @cached_property
    def pending(self) -> DataFrame:
        return sweep.pending_with_p50(self.stored_recommendations, self.quantiles)

    def queue(self, minutes_left: int) -> DataFrame:
        explanation = F.to_json(
            F.create_map(
                F.lit("uncertainty"),
                F.col("confidence_ratio"),
                F.lit("transit"),
                -F.col("transit_to_life_ratio"),
                F.lit("promotion"),
                F.col("promo_lift") - 1,
            )
        )
        return sweep.exception_queue(self.pending, F.lit(minutes_left), LOADED_AT, explanation)

    @cached_property
    def stored_queue(self) -> DataFrame:
        """The queue ten minutes before the deadline, as the table reviewers work on."""
        return self.published("exception_queue", lambda: self.queue(10))

    @cached_property
    def decisions(self) -> DataFrame:
        """Approvals of cheap rows, rejections of far-off ones, and a later second look.

        Some cheap rows were also rejected at the very time they were approved.
        """
        escalated = self.stored_queue.filter(F.col("sweeper_action") == "ESCALATE")
        value, off = F.col("order_value"), F.col("quantity_deviation_pct")

        def decision(rows, verdict, manager, at, reason, quantity):
            return rows.select(
                *review.QUEUE_KEY,
                F.lit(verdict).alias("manager_decision"),
                F.lit(manager).alias("manager_id"),
                F.lit(at).cast("timestamp").alias("decision_timestamp"),
                F.lit(reason).cast("string").alias("override_reason"),
                quantity.cast("int").alias("override_qty"),
            )

        half = F.floor(F.col("recommended_qty") / 2)
        none = F.lit(None)
        return (
            decision(
                escalated.filter(value < 400), "APPROVED", "M1", "1999-06-30 08:06:00", "ok", half
            )
            .unionByName(
                decision(
                    escalated.filter((value < 400) & (F.col("recommended_qty") % 3 == 0)),
                    "REJECTED", "M0", "1999-06-30 08:06:00", None, none,
                )
            )
            .unionByName(
                decision(
                    escalated.filter(off > 0.75), "REJECTED", "M2", "1999-06-30 08:07:00", None, none
                )
            )
            .unionByName(
                decision(
                    escalated.filter((off > 0.75) & (value > 900)),
                    "APPROVED",
                    "M3",
                    "1999-06-30 08:08:00",
                    None,
                    F.col("recommended_qty"),
                )
            )
        )

    @cached_property
    def reviewed_queue(self) -> DataFrame:
        return self.published("reviewed_queue", self.build_reviewed_queue)

    def build_reviewed_queue(self) -> DataFrame:
        return review.apply_decisions(self.stored_queue, self.decisions)

    @cached_property
    def finalized(self) -> DataFrame:
        return sweep.finalize_status(self.reviewed_queue)

    @cached_property
    def final_audit(self) -> DataFrame:
        """Audit of the final decisions."""
        confirmations = ordering.po_confirmations(self.responses(self.finalized))
        return ordering.po_audit(self.finalized, confirmations)

    @cached_property
    def audit(self) -> DataFrame:
        """Audit log of the day: automatic orders, then the final decisions."""
        return self.published(
            "po_audit",
            lambda: self.order_audit.unionByName(self.final_audit).withColumn(
                "_created_on", F.lit(self.reference_date)
            ),
        )

    @cached_property
    def consolidated(self) -> DataFrame:
        return sweep.daily_po_consolidation(self.audit, self.master, self.reference_date)

    @cached_property
    def edi_lines(self) -> DataFrame:
        """Numbered order lines as a table: file names and segments both read them."""
        return self.published("edi_lines", self.build_edi_lines)

    @cached_property
    def edi_files(self) -> DataFrame:
        return self.published("edi_files", lambda: edi.edi_files(self.edi_lines, EDI_TIMESTAMP))

    def build_edi_lines(self) -> DataFrame:
        return edi.edi_lines(self.consolidated, self.reference_date)

    # ---- documents -------------------------------------------------------------------

    @cached_property
    def documents(self) -> DataFrame:
        return self.table("documents").select(
            F.col("doc_id").cast("string").alias("path"), "text"
        )

    @cached_property
    def manifest(self) -> DataFrame:
        """Earlier run over the labelled documents; bad ones have changed since."""
        right = F.sha2(F.col("text").cast("binary"), 256)
        return (
            self.table("documents")
            .join(self.table("labels").select("doc_id", "quality"), "doc_id", "inner")
            .select(
                F.col("doc_id").cast("string").alias("path"),
                F.when(F.col("quality") == 1, right).otherwise(F.lit("outdated")).alias("hash"),
                F.lit("1999-06-29T00:00:00").alias("processed_at"),
            )
        )
