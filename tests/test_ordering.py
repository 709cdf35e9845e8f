import json
import random
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from larder.operators import ordering
from larder.operators.phantom import SafetyCapExceeded

KEY = "werks string, unified_sku_id string"
SIZED = (
    KEY + ", category string, transit_to_life_ratio double, recommended_qty int, blocked boolean, "
    "solver_status string"
)
INPUT = (
    KEY + ", p10 double, p50 double, p90 double, promo_lift double, weather_lift double, stock_qty int, "
    "unit_cost double, transit_days int, min_order_qty int, max_order_qty int, category string, "
    "shelf_life_days int, truck_capacity_units double"
)


def order(p90=100.0, stock=20, least=1, most=200, truck=1000.0, category="DRY", p10=90.0, p50=95.0, cost=1.0, transit=1, life=7):
    return ("1", "S", p10, p50, p90, 1.0, 1.0, stock, cost, transit, least, most, category, life, truck)


@pytest.mark.parametrize(
    "inputs, quantity, status",
    [
        (order(), 80, "Optimal"),
        (order(p90=80.5, stock=20), 61, "Optimal"),
        (order(p90=10.0), 1, "Optimal"),
        (order(most=70), 0, "Infeasible"),
        (order(truck=79.9), 0, "Infeasible"),
        (order(truck=80.0), 80, "Optimal"),
        (order(p90=1.0, least=50, truck=40.0), 0, "Infeasible"),
    ],
)
def test_order_quantity(rows, inputs, quantity, status):
    got = ordering.order_quantity(rows(INPUT, inputs)).first()
    assert (got.recommended_qty, got.solver_status) == (quantity, status)


def test_order_quantity_against_search(rows):
    rng = random.Random(8)
    data = [
        order(rng.random() * 60, rng.randint(0, 30), rng.randint(0, 9), rng.randint(5, 40), rng.random() * 50)
        for _ in range(300)
    ]
    for r in ordering.order_quantity(rows(INPUT, *data)).collect():
        fits = [
            q
            for q in range(r.min_order_qty, r.max_order_qty + 1)
            if q >= max(0, r.p90 - r.stock_qty) and q <= r.truck_capacity_units
        ]
        assert r.recommended_qty == (min(fits) if fits else 0)
        assert r.solver_status == ("Optimal" if fits else "Infeasible")


@pytest.mark.parametrize(
    "category, ratio, quantity, policy, left",
    [
        ("FRESH_PRODUCE", 0.67, 80, "HARD_BLOCK", 0),
        ("FRESH_PRODUCE", 0.33, 80, "PASS", 80),
        ("FRESH_PRODUCE", 0.50, 80, "PASS", 80),
        ("BAKERY", 0.625, 80, "SOFT_CAP", 30),
        ("BAKERY", 0.75, 10, "SOFT_CAP", 2),
        ("BAKERY", 1.0, 80, "HARD_BLOCK", 0),
        ("BAKERY", 1.5, 80, "HARD_BLOCK", 0),
        ("BAKERY", 0.75, 2, "HARD_BLOCK", 0),
        ("DRY", 0.55, 80, "PASS", 80),
        ("DRY", 0.61, 80, "HARD_BLOCK", 0),
    ],
)
def test_ttl_policy(rows, category, ratio, quantity, policy, left):
    got = ordering.ttl_policy(rows(SIZED, ("1", "S", category, ratio, quantity, False, "Optimal"))).first()
    assert (got.ttl_policy_applied, got.recommended_qty) == (policy, left)
    assert got.blocked is (policy == "HARD_BLOCK")
    assert got.day_old_discount is (policy == "SOFT_CAP")
    assert got.solver_status == ("BLOCKED_TRANSIT_TO_LIFE" if policy == "HARD_BLOCK" else "Optimal")


GATE = KEY + ", recommended_qty int, unit_cost double, p10 double, p50 double, p90 double, blocked boolean"


@pytest.mark.parametrize(
    "row, status, reason",
    [
        ((100, 3.0, 90.0, 100.0, 110.0, False), "AUTO_APPROVED", None),
        ((100, 3.0, 60.0, 100.0, 140.0, False), "PENDING_REVIEW", "HIGH_UNCERTAINTY: ratio=0.800"),
        ((200, 3.0, 90.0, 100.0, 110.0, False), "PENDING_REVIEW", "HIGH_VALUE: €600.00"),
        ((250, 2.0, 85.0, 100.0, 115.0, False), "PENDING_REVIEW", "HIGH_UNCERTAINTY: ratio=0.300; HIGH_VALUE: €500.00"),
        ((0, 3.0, 60.0, 100.0, 140.0, True), "BLOCKED", None),
        ((10, 3.0, 0.0, 0.0, 5.0, False), "AUTO_APPROVED", None),
    ],
)
def test_approval_gate(rows, row, status, reason):
    got = ordering.approval_gate(rows(GATE, ("1", "S", *row))).first()
    assert (got.approval_status, got.approval_reason) == (status, reason)
    if status == "BLOCKED":
        assert (got.confidence_ratio, got.order_value) == (0.0, 0.0)


def test_solver_inputs_drop_incomplete_rows_and_cut_stock(rows):
    quantiles = rows(KEY + ", p10 double, p50 double, p90 double", ("1", "A", 1.0, 2.0, 3.0), ("1", "B", None, 2.0, 3.0))
    lifts = rows(KEY + ", promo_lift double, weather_lift double", ("1", "A", None, 1.0), ("1", "B", 1.0, 1.0))
    stock = rows(KEY + ", stock_qty decimal(13,3)", ("1", "A", D("2.7")), ("1", "B", D(1)))
    master = rows(
        KEY + ", unit_cost double, transit_days int, min_order_qty int, max_order_qty int, category string, "
        "shelf_life_days int, truck_capacity_units double",
        ("1", "A", 1.0, 1, 1, 9, "DRY", 5, 9.0),
        ("1", "B", 1.0, 1, 1, 9, "DRY", 5, 9.0),
    )
    got = ordering.solver_inputs(quantiles, lifts, stock, master)
    assert [(r.unified_sku_id, r.stock_qty) for r in got.collect()] == [("A", 2)]
    out = ordering.solver_output(got)
    assert len(out.columns) == 14 and out.first().promo_lift == 1.0
    spread = quantiles.withColumn("uncertainty_spread", F.col("p90") - F.col("p10"))
    assert len(ordering.order_recommendations(out, spread).columns) == 17


def test_cap_and_requests(rows):
    recommendations = rows(
        KEY + ", recommended_qty int, approval_status string",
        ("1", "A", 5, "AUTO_APPROVED"),
        ("1", "B", 0, "AUTO_APPROVED"),
        ("1", "C", 5, "PENDING_REVIEW"),
        ("1", "D", 6, "AUTO_APPROVED"),
    )
    candidates = ordering.po_candidates(recommendations)
    assert ordering.po_cap(candidates, 2).count() == 2
    with pytest.raises(SafetyCapExceeded):
        ordering.po_cap(candidates, 1)
    payload = json.loads(ordering.po_requests(candidates).orderBy("unified_sku_id").first().payload)
    assert payload == {
        "POHEADER": {"COMP_CODE": "1", "DOC_TYPE": "NB"},
        "POITEM": [{"MATERIAL": "A", "PLANT": "1", "QUANTITY": 5, "UNIT": "EA"}],
    }


def test_batched_requests_hold_every_line(rows):
    data = [("1", f"S{i:03d}", i + 1, "V1" if i % 3 else None) for i in range(90)]
    frame = rows(KEY + ", recommended_qty int, vendor_id string", *data)
    got = ordering.po_requests_batched(frame, F.lit(date(2024, 1, 5))).orderBy("section_no").collect()
    lines = {}
    for vendor in ("V1", "UNKNOWN"):
        own = [(r.section, json.loads(r.payload)) for r in got if r.vendor_id == vendor]
        assert own[0] == ("POHEADER", {"DOC_TYPE": "NB", "CREAT_DATE": ""})
        assert own[1] == ("POPARTNER", {"LANGU": "EN", "BUSN_PARTNR": vendor, "PART_ROLE": "LF"})
        items = [body for section, body in own[2:] if section == "POITEM"]
        assert [i["PO_ITEM"] for i in items] == [f"{n:05d}" for n in range(1, len(own) - 1)]
        assert {i["DELIV_DATE"] for i in items} == {"20240105"}
        lines[vendor] = [i["MATERIAL"] for i in items]
    assert {v: len(m) for v, m in lines.items()} == {"V1": 60, "UNKNOWN": 30}
    assert sorted(lines["V1"] + lines["UNKNOWN"]) == sorted(d[1] for d in data)


@pytest.mark.parametrize(
    "body, number, success, messages",
    [
        ('{"POHDR":{"EBELN":"45"},"RETURN":[{"TYPE":"S","MESSAGE":"created"}]}', "45", True, ["created"]),
        ('{"EXPPURCHASEORDER":"46","RETURN":[]}', "46", True, []),
        ('{"PO_NUMBER":"47"}', "47", True, []),
        ('{"MATERIALDOCUMENT":"49","MATDOCUMENTYEAR":"2026","RETURN":[{"TYPE":"S","MESSAGE":"posted"}]}', "49", True, ["posted"]),
        ('{"RETURN":[{"TYPE":"W"},{"TYPE":"E","MESSAGE":"no"}]}', "", False, ["", "no"]),
        ("", "", True, []),
        (None, "", False, ["no answer"]),
        ("<html>busy</html>", "", False, ["unreadable answer"]),
        ('{"PO_NUMBER":', "", False, ["unreadable answer"]),
        ("[1]", "", False, ["unreadable answer"]),
    ],
)
def test_confirmations(rows, body, number, success, messages):
    got = ordering.po_confirmations(rows(KEY + ", response string", ("1", "S", body))).first()
    assert (got.document_number, got.success, got.messages) == (number, success, messages)


def test_audit(rows):
    decided = rows(
        KEY + ", recommended_qty int, approval_status string, needs_order boolean",
        ("1", "A", 5, "FORCE_APPROVED", True),
        ("1", "B", 5, "BLOCKED", False),
        ("1", "C", 5, "FORCE_APPROVED", True),
        ("1", "D", 5, "FORCE_APPROVED", True),
    )
    confirmations = ordering.po_confirmations(
        rows(
            KEY + ", response string",
            ("1", "A", '{"PO_NUMBER":"47"}'),
            ("1", "C", '{"RETURN":[{"TYPE":"E","MESSAGE":"no"}]}'),
        )
    )
    got = {
        r.unified_sku_id: (r.bapi_status, r.po_number, r.bapi_message)
        for r in ordering.po_audit(decided, confirmations).collect()
    }
    assert got == {
        "A": ("ok", "47", None),
        "B": ("skipped", None, None),
        "C": ("error", None, "no"),
        "D": ("error", None, "no confirmation"),
    }


def test_recommendations_by_site(rows):
    frame = rows(
        KEY + ", recommended_qty int, transit_to_life_ratio double, approval_status string, run_date date",
        ("1", "A", 5, 0.1, "BLOCKED", date(2024, 1, 1)),
        ("2", "A", 5, 0.1, "AUTO_APPROVED", date(2024, 1, 2)),
    )
    got = ordering.recommendations_by_site(frame, "1").collect()
    assert [(r.site_id, r.blocked, r.run_date) for r in got] == [("1", True, "2024-01-01")]
    assert ordering.recommendations_by_site(frame, run_date=date(2024, 1, 2)).count() == 1
    assert ordering.recommendations_by_site(frame).count() == 2
