import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from larder.operators import edi, review, sweep
from larder.operators.phantom import NoRowsError
from larder.session import work_dir

KEY = "werks string, unified_sku_id string"


@pytest.mark.parametrize(
    "ratio, deviation, minutes, action, kind",
    [
        (0.3, 0.10, 30, "AUTO_APPROVE", None),
        (0.3, 0.10, 31, "ESCALATE", "Pending Deadline"),
        (0.3, 0.40, 10, "ESCALATE", "High Deviation"),
        (0.8, 0.10, 10, "BLOCK", "High Transit-to-Life"),
        (0.8, 0.90, 90, "BLOCK", "High Transit-to-Life"),
        (0.5, 0.25, 0, "AUTO_APPROVE", None),
        (None, None, 0, "AUTO_APPROVE", None),
    ],
)
def test_rule_chain(rows, ratio, deviation, minutes, action, kind):
    columns = F.col("r"), F.col("d"), F.col("m")
    got = rows("r double, d double, m int", (ratio, deviation, minutes)).select(
        sweep.rule_chain(*columns), sweep.exception_type(*columns)
    ).first()
    assert tuple(got) == (action, kind)


@pytest.mark.parametrize("quantity, p50, want", [(120, 100.0, 0.2), (80, 0.0, 0.0), (80, None, 0.0), (50, 100.0, 0.5)])
def test_quantity_deviation(rows, quantity, p50, want):
    frame = rows("q int, p double", (quantity, p50))
    assert frame.select(sweep.quantity_deviation(F.col("q"), F.col("p"))).first()[0] == pytest.approx(want)


@pytest.mark.parametrize(
    "utc, minutes",
    [
        ("2024-07-01 06:00:00", 15),
        ("2024-07-01 06:00:01", 14),
        ("2024-07-01 06:15:00", 0),
        ("2024-07-01 09:00:00", 0),
        ("2024-01-15 06:00:00", 75),
        ("2024-06-30 22:30:00", 465),
    ],
)
def test_minutes_to_deadline_in_local_time(rows, utc, minutes):
    """Summer and winter time, and a UTC evening that is already the next local day."""
    frame = rows("t string", (utc,)).select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert frame.select(sweep.minutes_to_deadline(sweep.wall_clock(F.col("t")))).first()[0] == minutes


@pytest.mark.parametrize(
    "action, decision, needed, status",
    [
        ("AUTO_APPROVE", None, True, "SWEEPER_AUTO_APPROVED"),
        ("ESCALATE", None, True, "FORCE_APPROVED"),
        ("ESCALATE", "APPROVED", True, "MANAGER_APPROVED"),
        ("ESCALATE", "REJECTED", False, "MANAGER_REJECTED"),
        ("BLOCK", None, False, "BLOCKED"),
    ],
)
def test_finalize(rows, action, decision, needed, status):
    got = sweep.finalize_status(rows("sweeper_action string, manager_decision string", (action, decision))).first()
    assert (got.needs_order, got.approval_status) == (needed, status)


RECOMMENDATION = (
    KEY + ", recommended_qty int, transit_to_life_ratio double, order_value double, approval_status string, p50 double"
)


def queue_of(rows, minutes=10):
    recommendations = rows(
        RECOMMENDATION,
        ("1", "A", 126, 0.3, 10.0, "PENDING_REVIEW", 7.0),
        ("1", "B", 138, 0.3, None, "PENDING_REVIEW", 7.0),
        ("2", "C", 100, 0.3, 10.0, "PENDING_REVIEW", 7.0),
        ("2", "D", 100, 0.9, 10.0, "PENDING_REVIEW", 7.0),
        ("2", "E", 100, 0.9, 10.0, "AUTO_APPROVED", 7.0),
        ("2", "F", 100, 0.2, 10.0, "PENDING_REVIEW", 7.0),
    )
    quantiles = rows(KEY + ", p50 double", *[(w, s, 100.0) for w, s in ("1A", "1B", "2C", "2D", "2E")])
    pending = sweep.pending_with_p50(recommendations, quantiles)
    assert pending.columns.count("p50") == 1
    text = F.lit('{"demand_trend": 0.15, "transit_ratio": -0.28, "flat": 0.15}')
    return sweep.exception_queue(pending, F.lit(minutes), "2024-01-01T06:15:00Z", text)


def test_queue_and_summary(rows):
    queue = queue_of(rows)
    got = {r.unified_sku_id: (r.sweeper_action, r.order_value) for r in queue.collect()}
    assert got == {
        "A": ("ESCALATE", 10.0),
        "B": ("ESCALATE", 0.0),
        "C": ("AUTO_APPROVE", 10.0),
        "D": ("BLOCK", 10.0),
        "F": ("AUTO_APPROVE", 10.0),
    }
    assert tuple(sweep.sweep_summary(queue).first()) == (5, 2, 1, 2, 0.4)
    assert tuple(sweep.sweep_summary(queue.limit(0)).first()) == (0, 0, 0, 0, 0.0)


def test_review_flow(rows):
    queue = queue_of(rows)
    listed = review.list_exceptions(queue).collect()
    assert [(r.unified_sku_id, r.status) for r in listed] == [("B", "PENDING"), ("A", "PENDING")]
    assert review.list_exceptions(queue, store_id="2").count() == 0
    one = review.get_exception(queue, listed[0].exception_id).collect()
    assert [r.unified_sku_id for r in one] == ["B"]
    with pytest.raises(ValueError):
        review.get_exception(queue, "1|A")

    log = rows(
        KEY + ", _loaded_at string, manager_decision string, manager_id string, decision_timestamp timestamp, "
        "override_reason string, override_qty int",
        ("1", "A", "2024-01-01T06:15:00Z", "APPROVED", "M1", datetime(2024, 1, 1, 7), "less", 50),
        ("1", "A", "2024-01-01T06:15:00Z", "REJECTED", "M2", datetime(2024, 1, 1, 8), None, None),
        ("1", "B", "2024-01-01T06:15:00Z", "APPROVED", "M1", datetime(2024, 1, 1, 7), None, None),
    )
    current = review.apply_decisions(queue, log)
    assert current.columns == queue.columns
    got = {r.unified_sku_id: r for r in current.collect()}
    assert (got["A"].manager_decision, got["A"].manager_id) == ("REJECTED", "M2")
    assert (got["A"].override_reason, got["A"].override_qty) == ("less", 50)
    assert (got["B"].manager_decision, got["B"].override_qty) == ("APPROVED", None)
    assert [r.status for r in review.list_exceptions(current, "BLOCKED").collect()] == ["BLOCKED"]
    assert review.list_exceptions(current, "APPROVED").count() == 1

    same = log.filter("unified_sku_id = 'A'").withColumn("decision_timestamp", F.lit(datetime(2024, 1, 1, 9)))
    for turned in (same, same.orderBy(F.col("manager_decision").desc())):
        tied = {r.unified_sku_id: r for r in review.apply_decisions(queue, turned.repartition(1)).collect()}
        assert (tied["A"].manager_decision, tied["A"].manager_id, tied["A"].override_qty) == ("REJECTED", "M2", 50)

    first_poll = review.list_exceptions(queue).limit(1)
    news = review.new_since_poll(review.list_exceptions(queue), first_poll).collect()
    assert [r.unified_sku_id for r in news] == ["A"]
    assert review.pending_count(review.list_exceptions(queue)).first()[0] == 2


def test_exception_id_round_trip(rows):
    frame = rows("i string", ("1|A|2024|x",))
    parts = frame.select(review.parse_exception_id(F.col("i")).alias("p")).first().p
    assert tuple(parts) == ("1", "A", "2024|x")
    with pytest.raises(Exception, match="not an exception id"):
        rows("i string", ("1|A",)).select(review.parse_exception_id(F.col("i"))).collect()


def test_ranked_contributions(rows):
    queue = queue_of(rows).filter("unified_sku_id = 'A'")
    got = [(r["rank"], r.feature, r.sign) for r in review.ranked_contributions(queue).collect()]
    assert got == [(1, "transit_ratio", "negative"), (2, "demand_trend", "positive"), (3, "flat", "positive")]
    empty = queue.withColumn("shap_values", F.lit("{}"))
    assert review.ranked_contributions(empty).count() == 0
    assert review.ranked_contributions(queue.withColumn("shap_values", F.lit(None).cast("string"))).count() == 0


def test_store_status(rows):
    got = {
        r.werks: (r.no_touch_rate, r.exceptions_pending, r.colour)
        for r in review.store_status(queue_of(rows), rows("werks string", ("1",), ("1",))).collect()
    }
    assert got["1"] == (0.0, 2, "amber")
    assert got["2"][1:] == (0, "red")


CONSOLIDATED = (
    KEY + ", recommended_qty int, po_number string, ean_barcode string, vendor_id string, unit_cost double, "
    "transit_days int"
)


def consolidated(rows):
    return rows(
        CONSOLIDATED,
        ("1", "A", 50, "4500001234", "8710624212483", "V001", 2.5, 2),
        ("1", "B", 30, "4500001235", "8710624212490", "V002", 1.8, 1),
        ("1", "C", 20, "4500001236", None, "V001", 2.5, None),
        ("1", "D", 7, "4500001237", "1", None, None, 1),
    )


def test_edi_lines_per_vendor(rows):
    got = edi.edi_lines(consolidated(rows), date(2024, 1, 31)).orderBy("vendor_id", "line_number").collect()
    assert [(r.vendor_id, r.line_number, r.quantity, r.ean_barcode, r.requested_ship_date) for r in got] == [
        ("UNKNOWN", 1, 7, "1", "20240201"),
        ("V001", 1, 50, "8710624212483", "20240202"),
        ("V001", 2, 20, "", "20240131"),
        ("V002", 1, 30, "8710624212490", "20240201"),
    ]


def document(lines, sender, vendor, stamp):
    """The document format, spelled out line by line."""
    day, minute, control = stamp[:8], stamp[8:12], stamp[-9:]
    out = [
        f"ISA*00*{' ' * 10}*00*{' ' * 10}*ZZ*{sender.ljust(15)}*ZZ*{vendor.ljust(15)}*{day}*{minute}*^*00501*{control}*0*P*:",
        f"GS*PO*{sender}*{vendor}*{day}*{minute}*1*X*005010",
        "ST*850*0001",
        f"BEG*00*NE*{lines[0].po_number}**{day}",
    ]
    for r in lines:
        out.append(f"PO1*{r.line_number}*{r.quantity}*EA*{r.unit_price}**UP*{r.ean_barcode}")
        out.append(f"DTM*010*{r.requested_ship_date}")
    return out + [f"CTT*{len(lines)}", f"SE*{2 * len(lines) + 6}*0001", "GE*1*1", f"IEA*1*{control}"]


def test_edi_documents_and_files(rows, spark):
    stamp = "20240131081000"
    lines = edi.edi_lines(consolidated(rows), date(2024, 1, 31))
    segments = edi.edi_documents(lines, "BUYER", stamp)
    by_vendor = {}
    for r in segments.orderBy("vendor_id", "segment_no").collect():
        by_vendor.setdefault(r.vendor_id, []).append(r)
    ordered = lines.orderBy("vendor_id", "line_number").collect()
    folder = work_dir(spark, "edi-test")
    edi.edi_sink(segments, f"{folder}-table")
    assert spark.read.parquet(f"{folder}-table").count() == segments.count()
    edi.edi_hand_over(spark.read.parquet(f"{folder}-table"), folder)
    for vendor, got in by_vendor.items():
        want = document([r for r in ordered if r.vendor_id == vendor], "BUYER", vendor, stamp)
        assert [r.segment for r in got] == want
        assert [r.segment_no for r in got] == list(range(1, len(want) + 1))
        place = f"{folder}/vendor_id={vendor}/edi_file={got[0].edi_file}"
        parts = sorted(p for p in os.listdir(place) if p.startswith("part-"))
        text = "".join(open(f"{place}/{p}", encoding="utf-8").read() for p in parts)
        assert text.splitlines() == want
    assert by_vendor["V001"][0].edi_file == f"EDI850_4500001234_{stamp}.edi"


def test_consolidation_of_the_day(rows):
    audit = rows(
        KEY + ", bapi_status string, _created_on date",
        ("1", "A", "ok", date(2024, 1, 1)),
        ("1", "B", "ok", date(2024, 1, 2)),
        ("1", "C", "error", date(2024, 1, 1)),
    )
    master = rows(KEY + ", ean_barcode string, vendor_id string, unit_cost double, transit_days int")
    got = sweep.daily_po_consolidation(audit, master, date(2024, 1, 1))
    assert [(r.unified_sku_id, r.vendor_id) for r in sweep.empty_guard(got).collect()] == [("A", None)]
    with pytest.raises(NoRowsError):
        sweep.empty_guard(sweep.daily_po_consolidation(audit, master, date(2024, 1, 3)))


def test_contract_row_shape(rows):
    """A queue row as the review contract holds it, explanation text included."""
    got = review.ranked_contributions(
        rows(
            KEY + ", _loaded_at string, shap_values string",
            ("S01", "SKU1", "20260508T061500Z", json.dumps({"demand_trend": 0.15, "transit_ratio": -0.08})),
        )
    ).collect()
    assert [(r.feature, r.contribution) for r in got] == [("demand_trend", 0.15), ("transit_ratio", -0.08)]
