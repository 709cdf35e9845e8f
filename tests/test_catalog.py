"""Every registered query against its SQL, and the daily run end to end, on the smallest data."""

from __future__ import annotations

import os
import shutil
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from larder import config
from larder.operators.phantom import NoRowsError, SafetyCapExceeded
from larder.plans import catalog, daily
from larder.plans.star import BANNER, SENDER, Star
from larder.session import work_dir
from tests.compare import compare, duck

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
CHECKS = catalog.oracle_sql()


# The smallest data holds no series of a year, so nothing to train on.
NEEDS_A_YEAR = {"m1_train", "m1_score", "hold_out_demand"}


def test_every_query_has_a_check():
    assert set(CHECKS) == set(catalog.queries())
    assert set(CHECKS) <= set(entry.queries())


@needs_data
def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


@needs_data
@pytest.mark.parametrize("name", sorted(set(CHECKS) - NEEDS_A_YEAR))
def test_query_equals_sql(spark, con, name):
    got = catalog.queries()[name](spark, DATA).toArrow()
    assert compare(got, con.sql(CHECKS[name]).to_arrow_table()) is None


@needs_data
@pytest.mark.parametrize("name", sorted(NEEDS_A_YEAR))
def test_short_series_train_nothing(spark, name):
    with pytest.raises(NoRowsError):
        catalog.queries()[name](spark, DATA)


@needs_data
def test_replaced_table_changes_the_answer(spark, tmp_path):
    for name in ("part", "lineitem", "supplier", "nation", "orders"):
        shutil.copyfile(f"{DATA}/{name}.parquet", tmp_path / f"{name}.parquet")
    before = Star(spark, str(tmp_path)).registry.count()
    spark.read.parquet(f"{DATA}/part.parquet").limit(5).toPandas().to_parquet(tmp_path / "part.parquet")
    assert Star(spark, str(tmp_path)).registry.count() == 5 < before
    table = Star(spark, str(tmp_path)).published("for_removal", lambda: spark.range(3))
    files = table.inputFiles()
    Star.clear(spark)
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)


@needs_data
def test_tables_stored_as_folders(spark, tmp_path):
    for name in ("lineitem", "supplier", "nation"):
        spark.read.parquet(f"{DATA}/{name}.parquet").repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    got = catalog.queries()["bronze_stream_read"](spark, str(tmp_path)).count()
    assert got == spark.read.parquet(f"{DATA}/lineitem.parquet").count()


@needs_data
def test_daily_run(spark):
    star, day = Star(spark, DATA), date(1999, 6, 30)
    store = daily.Store(spark, work_dir(spark, "daily"))
    feeds = {
        "materials": star.raw_materials,
        "inventory": star.raw_movements,
        "open_orders": star.raw_open_orders,
    }
    for name, df in feeds.items():
        df.write.parquet(store.path(f"landing/{name}"))
        daily.ingest(store, name, store.path(f"landing/{name}"))
    daily.refine(store, BANNER)
    daily.aggregate(store, day)
    daily.build_features(store, day)
    daily.train_phantom(store, day, config.TreeSettings(trees=3, depth=3, rate=0.3))
    requests = daily.score_phantom(store, max_corrections=10_000)
    metrics = daily.record_corrections(store, requests, star.responses(
        requests.withColumn("recommended_qty", F.lit(18))))
    assert metrics.first()["bapi_error_count"] == requests.count()
    scores = store.read("gold/phantom_scores")
    assert scores.count() == daily.feature_vector(store).count()
    assert requests.count() == scores.filter("action = 'AUTO_CORRECTED'").count()
    assert (
        store.read("gold/phantom_review").count()
        == scores.filter("action = 'PENDING_REVIEW'").count()
    )

    inputs = (star.quantiles, star.lifts, star.order_stock, star.master)
    with pytest.raises(SafetyCapExceeded):
        daily.order(store, *inputs)
    orders = daily.order(store, *inputs, max_orders=10_000)
    daily.record_orders(store, orders, star.responses(orders), day)
    queue = daily.load_exceptions(store, star.quantiles, datetime(1999, 6, 30, 6, 5))
    final = daily.finalize(store)
    assert final.count() == queue.count() > 0
    daily.record_orders(store, final, star.responses(final), day)
    audit = store.read("gold/po_audit")
    assert audit.count() == orders.count() + final.count()
    blocked = final.filter("sweeper_action = 'BLOCK'").select(*daily.KEYS)
    assert audit.filter("bapi_status = 'ok'").join(blocked, daily.KEYS).count() == 0
    files = daily.release(store, star.master, day, SENDER, "19990630081000")
    written = spark.read.text(store.path("edi/19990630081000"))
    assert written.select("vendor_id").distinct().count() == files.count()
    lines = files.agg(F.sum("n_lines")).first()[0]
    assert written.count() == 2 * lines + 8 * files.count()


@needs_data
def test_daily_demand(spark):
    """Series by material type and by SKU; short ones fall back, weather comes from bodies."""
    folder = DATA.replace("sf0.001", "sf0.01")
    if not os.path.isdir(folder):
        pytest.skip("no larger test data")
    star, day = Star(spark, folder), date(1999, 6, 30)
    store = daily.Store(spark, work_dir(spark, "daily-demand"))
    store.replace("silver/inventory_clean", star.inventory)
    daily.train_demand(store, day, star.kinds, 14, config.TreeSettings(trees=1, depth=2, rate=0.3))
    series = star.series.select(*daily.KEYS).distinct().dropna()
    fresh = series.withColumn("unified_sku_id", F.lit("NEW")).distinct()
    categories = series.unionByName(fresh).withColumn("category", F.col("werks"))
    daily.score_demand(store, day, categories, star.weather_bodies, star.kinds)
    held_out = daily.hold_out_demand(store, day, star.kinds, 14, config.TreeSettings(trees=1, depth=2, rate=0.3))
    assert {r.horizon_days for r in held_out.filter("mae > 0").collect()} == {7, 14, 28}
    daily.learn_weather(store, star.weather_bodies)
    daily.score_demand(store, day, categories, star.weather_bodies, star.kinds)
    filled = store.read("demand/with_fallback")
    assert filled.filter("is_fallback").count() == fresh.count() and filled.filter("forecast_7d IS NULL").count() == 0
    assert 0.5 <= store.read("demand/weather_lift").first().weather_lift <= 2.0
    out = store.read("demand/m4_probabilistic")
    assert out.count() == categories.count() == store.read("demand/m1_forecast").count() + fresh.count()
    assert out.filter("p10 <= p50 and p50 <= p90 and p10 >= 0").count() == out.count()


def test_daily_demand_has_a_series_for_every_sku(spark, tmp_path):
    """Two parts of one type, and one of a type that is no replenished material, sold on one day."""
    tables = {
        "nation": spark.range(1).selectExpr("0 AS n_nationkey", "'N' AS n_name", "1 AS n_regionkey"),
        "supplier": spark.range(1).selectExpr("7L AS s_suppkey", "'S' AS s_name", "0 AS s_nationkey", "1D AS s_acctbal"),
        "part": spark.range(1, 4).selectExpr(
            "id AS p_partkey", "'bolt' AS p_name", "'B' AS p_brand", "if(id = 3, 'PROMO', 'SMALL') AS p_type", "1 AS p_size", "1D AS p_retailprice"),
        "lineitem": spark.range(1, 7).selectExpr(
            "id AS l_orderkey", "1 + id % 3 AS l_partkey", "7L AS l_suppkey", "4 AS l_linenumber", "CAST(id AS double) AS l_quantity", "1D AS l_extendedprice",
            "0D AS l_discount", "0D AS l_tax", "'N' AS l_returnflag", "'O' AS l_linestatus", "TIMESTAMP_NTZ'1999-06-01 00:00:00' AS l_shipdate"),
    }
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    got = {tuple(r) for r in catalog.QUERIES["daily_demand"](Star(spark, str(tmp_path))).collect()}
    day = date(1999, 6, 1)
    assert got == {("NL01", f"87{part:011d}", day, y) for part, y in ((1, 9.0), (2, 5.0), (3, 7.0))}


def test_line_items_are_not_shuffled_to_meet_their_site(spark, tmp_path):
    """The estimate of a join of suppliers and nations is the product of both, however few rows it has."""
    tables = {
        "nation": spark.range(25).selectExpr("CAST(id AS int) AS n_nationkey", "concat('NATION_', id) AS n_name", "CAST(id % 5 AS int) AS n_regionkey"),
        "supplier": spark.range(2000).selectExpr(
            "id AS s_suppkey", "sha2(CAST(id AS string), 256) AS s_name", "CAST(id % 25 AS int) AS s_nationkey", "rand(1) AS s_acctbal"),
        "lineitem": spark.range(50_000).selectExpr(
            "id AS l_orderkey", "id AS l_partkey", "id % 7 AS l_suppkey", "1 AS l_linenumber", "1D AS l_quantity", "1D AS l_extendedprice",
            "0D AS l_discount", "0D AS l_tax", "'N' AS l_returnflag", "'O' AS l_linestatus", "TIMESTAMP_NTZ'1999-06-01 00:00:00' AS l_shipdate"),
    }
    for name, table in tables.items():
        table.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    setting = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(setting, "100kb")  # below the line items
    try:
        lines = Star(spark, str(tmp_path)).lines
        assert "hashpartitioning" not in lines._jdf.queryExecution().executedPlan().toString()
        assert lines.filter("l_suppkey % 5 = n_regionkey").count() == lines.count() == 50_000
    finally:
        spark.conf.unset(setting)


@needs_data
def test_replayed_labels_are_computed_once_for_both_sides(spark):
    """The scores need fewer columns than the labels, so Spark would replay the movements twice."""
    plan = catalog.queries()["backtest_precision"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "BUDAT" not in plan and "net" not in plan
