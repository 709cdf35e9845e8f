from datetime import date
from decimal import Decimal as D

import pytest

from larder.operators import features, gold, silver

MATERIALS = (
    "MATNR string, EAN11 string, MAKTX string, MTART string, MATKL string, MEINS string, "
    "MHDRZ decimal(5,0), MHDLP decimal(5,0), LAEDA date"
)
INVENTORY = (
    "MBLNR string, ZEILE string, MATNR string, WERKS string, LGORT string, BWART string, "
    "MENGE decimal(13,3), MEINS string, BUDAT string, CPUDT string"
)
MOVES = (
    "WERKS string, unified_sku_id string, BWART string, MENGE decimal(13,3), MEINS string, BUDAT date"
)
REGISTRY = "sap_material_number string, unified_sku_id string"


def material(number, ean, kind="FERT", day=date(2024, 1, 1)):
    return (number, ean, "Apple", kind, "G1", "KG", D(7), D(3), day)


def move(number="1", line="1", code="101", qty="10", entered="2024-01-02", site="1000"):
    return (number, line, "MAT001", site, "0001", code, D(qty), "KG", "2024-01-01", entered)


def test_registry_uses_barcode_or_synthetic_id(rows):
    got = silver.sku_registry(
        rows(
            MATERIALS,
            material("MAT001", "5000112345678"),
            material("MAT002", None),
            material("MAT003", "1", day=date(2023, 1, 1)),
            material("MAT003", "2", day=date(2024, 1, 1)),
        ),
        "HOME",
    ).collect()
    by = {r.sap_material_number: r for r in got}
    assert len(got) == 3
    assert (by["MAT001"].unified_sku_id, by["MAT001"].match_confidence) == ("5000112345678", 1.0)
    assert (by["MAT002"].unified_sku_id, by["MAT002"].match_confidence) == ("MATNR-MAT002", 0.0)
    assert by["MAT003"].ean_barcode == "2"
    assert {r.source_banner for r in got} == {"HOME"}
    assert by["MAT001"].material_group == "G1"


@pytest.mark.parametrize("missing, ready", [(1, False), (0, True)])
def test_match_rate_gate(rows, missing, ready):
    data = [("e", 1.0)] * 3 + [(None, 0.0)] * missing
    got = silver.registry_ready(rows("ean_barcode string, match_confidence double", *data)).first()
    assert got.match_rate == 3 / (3 + missing)
    assert got.is_ready is ready


def test_match_rate_with_two_codes_and_no_rows(rows):
    schema = "ean_barcode string, other_code string"
    got = silver.match_rate(rows(schema, ("a", "x"), ("b", None)), "ean_barcode", "other_code")
    assert got.first().match_rate == 0.5
    assert silver.match_rate(rows(schema)).first().match_rate == 0.0


def test_clean_materials(rows):
    got = silver.clean_materials(
        rows(
            MATERIALS,
            material("A", "1", "DIEN"),
            material("B", "1"),
            material("B", "2", day=date(2024, 2, 1)),
            material(None, "3"),
        )
    ).collect()
    assert [(r.MATNR, r.EAN11, r.MHDRZ) for r in got] == [("B", "2", 7)]


def test_clean_inventory_keeps_newest_known_movement(rows):
    got = silver.clean_inventory(
        rows(
            INVENTORY,
            move(),
            move(code="601", qty="4", entered="2024-01-05"),
            move(number="2", code="999"),
            move(number=None),
        )
    ).collect()
    assert [(r.MBLNR, r.BWART, r.BUDAT, r.CPUDT) for r in got] == [
        ("1", "601", date(2024, 1, 1), date(2024, 1, 5))
    ]


def test_clean_inventory_hot_document(rows, spark):
    """A third of all rows are versions of one line; the plan thins them before the shuffle."""
    data = [move(number="hot", qty=str(i), entered=f"2024-01-{1 + i % 28:02d}") for i in range(300)]
    data += [move(number=f"n{i}") for i in range(600)]
    got = silver.clean_inventory(rows(INVENTORY, *data))
    plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    assert "WindowGroupLimit" in plan
    hot = got.filter("MBLNR = 'hot'").collect()
    assert got.count() == 601
    assert [(r.CPUDT, r.MENGE) for r in hot] == [(date(2024, 1, 28), D("27"))]


def test_clean_open_orders_drops_empty_lines(rows):
    schema = (
        "EBELN string, EBELP string, MATNR string, WERKS string, LIFNR string, "
        "MENGE decimal(13,3), MEINS string, EINDT string, BEDAT string"
    )
    line = lambda n, q: (n, "1", "M", "1000", "V", D(q), "KG", "2024-04-15", "2024-04-01")
    got = silver.clean_open_orders(rows(schema, line("1", "0"), line("2", "5"))).collect()
    assert [(r.EBELN, r.EINDT) for r in got] == [("2", date(2024, 4, 15))]


def test_enriched_movements_keeps_unknown_materials(rows):
    inventory = silver.clean_inventory(
        rows(INVENTORY, move(), move(number="2")[:2] + ("OTHER",) + move()[3:])
    )
    registry = rows(REGISTRY + ", match_confidence double", ("MAT001", "500", 1.0))
    materials = silver.clean_materials(rows(MATERIALS, material("MAT001", "500")))
    got = silver.enriched_movements(inventory, silver.material_dimension(materials, registry))
    assert {(r.MATNR, r.unified_sku_id, r.material_description) for r in got.collect()} == {
        ("MAT001", "500", "Apple"),
        ("OTHER", None, None),
    }
    assert silver.confidence_filter(got).count() == 1


def test_daily_positions(rows):
    moves = rows(
        MOVES,
        ("1000", "S", "101", D(10), "KG", date(2024, 1, 1)),
        ("1000", "S", "601", D(3), "KG", date(2024, 1, 2)),
    )
    got = gold.daily_positions(moves).first()
    assert (got.stock_qty, got.snapshot_date, got.uom) == (D("7.000"), date(2024, 1, 2), "KG")


def test_positions_are_the_last_history_rows(rows):
    """Also with two units on the last day, and through a registry that merges materials."""
    moves = rows(
        MOVES.replace("unified_sku_id", "MATNR"),
        ("1000", "A", "101", D(10), "KG", date(2024, 1, 1)),
        ("1000", "B", "101", D(5), "EA", date(2024, 1, 3)),
        ("1000", "B", "602", D(1), "KG", date(2024, 1, 3)),
        ("1000", "A", "261", D(2), "KG", date(2024, 1, 2)),
        ("1000", "A", "999", D(9), "KG", date(2024, 1, 2)),
    )
    registry = rows(REGISTRY, ("A", "S"), ("B", "S"))
    history = gold.position_history(moves, registry).orderBy("snapshot_date", "uom").collect()
    assert [r.stock_qty for r in history] == [D(10), D(8), D(13), D(14)]
    last = gold.daily_positions(moves, registry).collect()
    assert [(r.stock_qty, r.uom) for r in last] == [(history[-1].stock_qty, history[-1].uom)]


def test_sales_velocity_windows(rows):
    ref = date(2024, 4, 1)
    moves = rows(
        MOVES,
        ("1000", "S", "601", D(5), "KG", date(2024, 3, 30)),
        ("1000", "S", "601", D(3), "KG", date(2024, 3, 10)),
        ("1000", "S", "601", D(2), "KG", date(2024, 1, 10)),
        ("1000", "T", "601", D(10), "KG", date(2024, 3, 30)),
        ("1000", "T", "602", D(2), "KG", date(2024, 3, 30)),
        ("1000", "U", "101", D(2), "KG", date(2024, 3, 30)),
    )
    got = {r.unified_sku_id: r for r in gold.sales_velocity(moves, ref).collect()}
    s = got["S"]
    assert (s.sales_7d, s.sales_14d, s.sales_28d, s.sales_90d) == (D(5), D(5), D(8), D(10))
    assert got["T"].sales_7d == D(8)
    assert set(got) == {"S", "T"}


def test_open_orders(rows):
    orders = rows(
        "MATNR string, WERKS string, MENGE decimal(13,3), MEINS string, EINDT date",
        ("A", "1000", D(50), "KG", date(2024, 4, 15)),
        ("A", "1000", D(30), "KG", date(2024, 3, 15)),
    )
    got = gold.open_orders(orders, date(2024, 4, 1), rows(REGISTRY, ("A", "S"))).collect()
    assert [(r.unified_sku_id, r.open_qty, r.earliest_delivery) for r in got] == [
        ("S", D(50), date(2024, 4, 15))
    ]


VELOCITY = (
    "werks string, unified_sku_id string, sales_7d decimal(13,3), sales_14d decimal(13,3), "
    "sales_28d decimal(13,3), sales_90d decimal(13,3), uom string"
)
POSITIONS = (
    "werks string, unified_sku_id string, snapshot_date date, stock_qty decimal(13,3), uom string"
)


@pytest.mark.parametrize(
    "stock, week, cover",
    [("10", "7", D("10.00")), ("10", "0", None), ("2", "16", D("0.88")), ("1", "40", D("0.17")), ("9999999999", "0.001", None)],
)
def test_days_of_cover(rows, stock, week, cover):
    """Zero sales and covers too large for the type are NULL; the week rate is rounded first."""
    got = features.stock_features(
        rows(POSITIONS, ("1", "S", date(2024, 1, 1), D(stock), "KG")),
        rows(VELOCITY, ("1", "S", D(week), D(0), D(0), D(0), "KG")),
    ).first()
    assert got.days_of_cover == cover


def test_collapse_signals(rows):
    moves = rows(MOVES, ("1", "S", "601", D(5), "KG", date(2024, 1, 22)))
    last = gold.last_sale(moves, date(2024, 2, 1))
    registry = rows(
        REGISTRY + ", shelf_life_days decimal(5,0)", ("A", "S", D(7)), ("B", "S", D(9))
    )
    velocity = rows(VELOCITY, ("1", "S", D(1), D(1), D(4), D(4), "KG"), ("1", "T", D(0), D(0), D(0), D(0), "KG"))
    got = {r.unified_sku_id: r for r in features.collapse_signals(velocity, last, registry).collect()}
    assert len(got) == 2
    assert (got["S"].velocity_collapse_ratio, got["S"].days_since_last_sale) == (0.25, 10)
    assert got["S"].shelf_life_days == 7
    assert got["T"].velocity_collapse_ratio is None


def test_feature_vector_has_each_column_once(rows):
    velocity = rows(VELOCITY, ("1", "S", D(1), D(1), D(4), D(4), "KG"))
    stock = features.stock_features(
        rows(POSITIONS, ("1", "S", date(2024, 1, 1), D(3), "KG")), velocity
    )
    collapse = rows(
        "werks string, unified_sku_id string, velocity_collapse_ratio double, "
        "days_since_last_sale int, shelf_life_days int",
        ("1", "S", 0.25, 3, 7),
    )
    got = features.feature_vector(velocity, stock, collapse)
    assert len(got.columns) == len(set(got.columns)) == 12
    assert got.count() == 1


def test_moving_averages_count_days_without_sales(rows):
    series = rows(
        "werks string, unified_sku_id string, ds date, y decimal(13,3)",
        ("1", "S", date(2024, 1, 1), D(7)),
        ("1", "S", date(2024, 1, 7), D(14)),
        ("1", "S", date(2024, 1, 8), D(7)),
    )
    got = features.sales_moving_averages(series).orderBy("ds").collect()
    assert [r.avg_7d for r in got] == [1.0, 3.0, 3.0]
