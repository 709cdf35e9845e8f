import os
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from larder.operators import quality
from larder.session import work_dir
from larder.sources import files, sinks
from larder.sources.feeds import FEEDS, conform, join_header_item
from larder.streaming import bronze

KEY = "werks string, unified_sku_id string"


def inventory(rows, *numbers):
    frame = rows("MBLNR string, ZEILE string, MENGE double", *[(n, "1", 2.5) for n in numbers])
    return conform(frame, FEEDS["inventory"])


def test_feed_schemas():
    assert [f.name for f in FEEDS["inventory"].schema.fields] == [
        "MBLNR", "ZEILE", "MATNR", "WERKS", "LGORT", "BWART", "MENGE", "MEINS", "BUDAT", "CPUDT", "CPUTM",
    ]
    assert FEEDS["open_orders"].schema["NETPR"].dataType.simpleString() == "decimal(11,2)"
    assert FEEDS["materials"].keys == ("MATNR", "WERKS")
    assert {f.target for f in FEEDS.values()} == {"bronze/materials", "bronze/inventory", "bronze/open_orders"}


def test_second_run_adds_nothing_and_new_files_are_found(rows, spark):
    base, feed = work_dir(spark, "ingest"), FEEDS["inventory"]

    def run():
        stream = bronze.read_feed_stream(spark, f"{base}/landing", feed.schema)
        bronze.append_available(bronze.with_audit_columns(stream), f"{base}/table", f"{base}/state")
        return spark.read.parquet(f"{base}/table")

    inventory(rows, "1", "2").write.mode("append").parquet(f"{base}/landing")
    assert run().count() == 2
    assert run().count() == 2
    inventory(rows, "3").write.mode("append").parquet(f"{base}/landing")
    got = run()
    assert sorted(r.MBLNR for r in got.collect()) == ["1", "2", "3"]
    assert got.filter("_source_file like '%landing%' and _cdc_operation <> ''").count() == 3
    assert got.schema["MENGE"].dataType.simpleString() == "decimal(13,3)"


def test_a_new_column_arrives_on_the_stream(rows, spark):
    base, feed = work_dir(spark, "grown"), FEEDS["inventory"]
    old = inventory(rows, "1", "2")
    for landed in (old, inventory(rows, "3").withColumn("CHARG", F.lit("B7"))):
        landed.write.mode("append").parquet(f"{base}/landing")
        schema = bronze.grown_schema(spark, f"{base}/landing", feed.schema)
        stream = bronze.read_feed_stream(spark, f"{base}/landing", schema)
        bronze.append_available(bronze.with_audit_columns(stream), f"{base}/table", f"{base}/state")
    got = bronze.read_evolved(spark, f"{base}/table").select("MBLNR", "CHARG").collect()
    assert sorted((r.MBLNR, r.CHARG) for r in got) == [("1", None), ("2", None), ("3", "B7")]
    assert bronze.grown_schema(spark, f"{base}/nothing", feed.schema) == feed.schema


def test_backlog_is_drained_in_batches(rows, spark):
    base, feed = work_dir(spark, "backlog"), FEEDS["inventory"]
    inventory(rows, *"abcdefgh").repartition(4).write.parquet(f"{base}/landing")
    stream = bronze.read_feed_stream(spark, f"{base}/landing", feed.schema, files_per_batch=1)
    bronze.append_available(bronze.with_audit_columns(stream), f"{base}/table", f"{base}/state")
    got = spark.read.parquet(f"{base}/table")
    assert sorted(r.MBLNR for r in got.collect()) == list("abcdefgh")
    assert got.select("_source_file").distinct().count() > 1


def test_audit_columns_without_files(rows):
    got = bronze.with_audit_columns(rows("a int", (1,))).first()
    assert (got._source_file, got._cdc_operation) == ("", "")
    assert got._ingested_at is not None


def test_schema_evolution(rows, spark):
    target = work_dir(spark, "evolve")
    rows("a int", (1,)).write.mode("append").parquet(target)
    rows("a int, b string", (2, "x")).write.mode("append").parquet(target)
    for got in (bronze.read_evolved(spark, target), bronze.read_evolved(spark, target, "a int, b string")):
        assert {tuple(r) for r in got.select("a", "b").collect()} == {(1, None), (2, "x")}


def test_header_and_items(rows):
    items = rows("MBLNR string, ZEILE string, BUDAT string", ("1", "1", "item"), ("1", "2", "item"), ("9", "1", "item"))
    headers = rows("MBLNR string, BUDAT string, USNAM string", ("1", "head", "u"), ("2", "head", "u"))
    got = join_header_item(items, headers, ["MBLNR"]).collect()
    assert {(r.ZEILE, r.BUDAT, r.USNAM) for r in got} == {("1", "item", "u"), ("2", "item", "u")}


def test_expectations(rows):
    frame = rows("a int", (1,), (None,), (-1,), (5,))
    seen, warned = Observation("seen"), Observation("warned")
    kept = quality.expect_or_drop(frame, "positive", "a > 0", seen)
    assert sorted(r.a for r in kept.collect()) == [1, 5]
    assert seen.get == {"positive_passed": 2, "positive_dropped": 2}
    assert quality.expect_warn(frame, "small", F.col("a") < 5, warned).count() == 4
    assert warned.get == {"small_failed": 2}
    report = quality.expectation_report(frame, {"positive": "a > 0", "small": F.col("a") < 5})
    assert [tuple(r) for r in report.collect()] == [("positive", 2, 2), ("small", 2, 2)]


def test_publish(rows, spark):
    base = work_dir(spark, "publish")
    sinks.publish_overwrite(rows("a int", (1,), (2,)), f"{base}/t")
    sinks.publish_overwrite(rows("a int", (3,)), f"{base}/t")
    assert [r.a for r in spark.read.parquet(f"{base}/t").collect()] == [3]
    sinks.publish_append(rows("a int, d date", (1, date(2024, 1, 1))), f"{base}/log", partition_by=["d"])
    sinks.publish_append(rows("a int, d date", (1, date(2024, 1, 2))), f"{base}/log", partition_by=["d"])
    log = spark.read.parquet(f"{base}/log")
    assert log.count() == 2 and log.filter("_created_at is null").count() == 0
    day = log.filter(F.col("d") == F.lit(date(2024, 1, 2)))
    plan = spark._jvm.PythonSQLUtils.explainString(day._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(d" in plan


def test_feature_keys_are_checked_before_publishing(rows, spark):
    target = work_dir(spark, "keys")
    good = rows(KEY + ", v int", ("1", "A", 1), ("1", "B", 1))
    sinks.publish_features(good, target, ["werks", "unified_sku_id"])
    for bad in (("1", "A", 2), ("1", None, 2)):
        with pytest.raises(sinks.DuplicateKeyError):
            sinks.publish_features(
                good.unionByName(rows(KEY + ", v int", bad)), target, ["werks", "unified_sku_id"]
            )
    assert spark.read.parquet(target).count() == 2


def test_text_files_and_changes(rows, spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.md").write_text("# one\nline\n", encoding="utf-8")
    (tmp_path / "deep" / "b.txt").write_text("zwei é", encoding="utf-8")
    (tmp_path / "c.pdf").write_text("no", encoding="utf-8")
    (tmp_path / "D.TXT").write_text("loud", encoding="utf-8")
    (tmp_path / "plain").write_text("no suffix", encoding="utf-8")
    left = {r.path.rsplit("/", 1)[1] for r in files.other_files(spark, str(tmp_path)).collect()}
    assert left == {"c.pdf", "plain"}
    docs = files.text_file_scan(spark, str(tmp_path))
    docs = docs.withColumn("path", F.regexp_extract("path", "([^/]+)$", 1))
    got = {r.path: r.text for r in docs.collect()}
    assert got == {"a.md": "# one\nline\n", "b.txt": "zwei é", "D.TXT": "loud"}
    docs = docs.filter("path != 'D.TXT'")

    empty = rows("path string, hash string, processed_at string")
    first = files.changed_documents(docs, empty)
    assert {(r.path, r.reason) for r in first.collect()} == {("a.md", "new"), ("b.txt", "new")}
    processed = first.filter("path = 'a.md'").withColumn("processed_at", F.lit("2024-01-01"))
    manifest = files.manifest_update(empty, processed)
    assert [r.path for r in files.changed_documents(docs, manifest).collect()] == ["b.txt"]
    edited = docs.withColumn("text", F.concat("text", F.lit("!")))
    again = files.changed_documents(edited, manifest)
    assert {(r.path, r.reason) for r in again.collect()} == {("a.md", "changed"), ("b.txt", "new")}
    newer = files.manifest_update(manifest, again.withColumn("processed_at", F.lit("2024-01-02")))
    assert {(r.path, r.processed_at) for r in newer.collect()} == {("a.md", "2024-01-02"), ("b.txt", "2024-01-02")}


def test_work_dir_is_below_the_named_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = work_dir(spark, "x"), work_dir(spark, "x")
    assert one != two and one.startswith(base)


def test_no_forbidden_calls():
    """Operators neither collect rows nor keep blocks on executors only."""
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "larder")
    for folder, _dirs, names in os.walk(root):
        for name in names:
            if name.endswith(".py"):
                text = open(os.path.join(folder, name), encoding="utf-8").read()
                for call in (".toPandas(", "localCheckpoint", "crossJoin", "@F.udf", "pandas_udf", ".rdd"):
                    assert call not in text, f"{name}: {call}"


def test_a_repeated_run_leaves_one_set_of_rows(spark, rows, tmp_path):
    target = f"{tmp_path}/log"
    first = rows("a int, t timestamp", (1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 1)))
    later = rows("a int, t timestamp", (2, datetime(2024, 1, 2)), (1, datetime(2024, 1, 2)))
    other = rows("a int, t timestamp", (1, datetime(2024, 1, 1)), (3, None))
    names = [sinks.publish_run(df, target, ignore=["t"]) for df in (first, later, other)]
    assert names[0] == names[1] != names[2]
    log = spark.read.parquet(target)
    assert sorted((r.a, r._run_id) for r in log.collect()) == sorted([(1, names[0]), (2, names[0]), (1, names[2]), (3, names[2])])
    assert log.filter("_created_at IS NULL").count() == 0
    sinks.publish_run(other, f"{tmp_path}/parts", "day/1 & more", partition_by=["a"])
    assert {r._run_id for r in spark.read.parquet(f"{tmp_path}/parts").collect()} == {"day/1 & more"}
    sinks.publish_run(first, f"{tmp_path}/named", "r1")
    sinks.publish_run(other.limit(0), f"{tmp_path}/named", "r1")
    assert spark.read.parquet(f"{tmp_path}/named").count() == 0
    assert sinks.publish_run(first, f"{tmp_path}/named", "r2") == "r2"
    assert spark.read.parquet(f"{tmp_path}/named").count() == 2


def test_a_lost_replacement_leaves_the_old_rows(spark, rows, tmp_path):
    target = f"{tmp_path}/t"
    sinks.publish_overwrite(rows("a int", (1,), (2,)), target)
    broken = spark.read.parquet(target).withColumn("a", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        sinks.publish_overwrite(broken, target)
    assert spark.read.parquet(target).count() == 2
    sinks.publish_overwrite(spark.read.parquet(target).select((F.col("a") + 1).alias("a")), target)
    assert sorted(r.a for r in spark.read.parquet(target).collect()) == [2, 3]
