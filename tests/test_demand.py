import json
from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from larder import config
from larder.functions.calendar import dutch_public_holidays
from larder.operators import demand
from larder.operators.phantom import NoRowsError
from larder.sources.weather import weather_rows

KEY = "werks string, unified_sku_id string"
SERIES = KEY + ", ds date, y decimal(13,3)"
START = date(2024, 1, 1)


def series(rows, days, value=lambda i: 10, sku="S"):
    return rows(SERIES, *[("1", sku, START + timedelta(days=i), D(value(i))) for i in range(days)])


def test_history_gate(rows):
    both = series(rows, 14).unionByName(series(rows, 13, sku="T"))
    assert {r.unified_sku_id for r in demand.history_gate(both, 14).collect()} == {"S"}
    got = {r.unified_sku_id: r.can_score for r in demand.history_summary(both).collect()}
    assert got == {"S": True, "T": False}


def test_components_recover_trend_and_weekday(rows):
    weekly = [0, 3, -3, 6, -6, 2, -2]
    got = demand.seasonal_components(series(rows, 70, lambda i: 100 + i + weekly[i % 7])).collect()
    for r in got:
        i = (r.ds - START).days
        assert r.trend + r.weekly + r.yearly == pytest.approx(float(r.y), abs=1.5)
        assert r.weekly == pytest.approx(weekly[i % 7], abs=1.0)


def test_components_of_one_day(rows):
    got = demand.seasonal_components(series(rows, 1)).first()
    assert (got.trend, got.weekly, got.yearly) == (10.0, 0.0, 0.0)


def test_holidays(spark):
    got = {r.holiday_date for r in dutch_public_holidays(spark, 1999, 2025).collect()}
    easters = [date(1999, 4, 4), date(2000, 4, 23), date(2008, 3, 23), date(2019, 4, 21), date(2024, 3, 31)]
    assert set(easters) <= got
    assert {date(2024, 4, 27), date(2025, 4, 26), date(2000, 4, 29), date(2001, 4, 30)} <= got
    assert date(2025, 5, 5) in got and date(2024, 5, 5) not in got
    assert {date(2024, 5, 9), date(2024, 5, 19), date(2024, 5, 20), date(2024, 12, 26)} <= got


def test_calendar_features(rows, spark):
    got = demand.calendar_features(
        rows("ds date", (date(2024, 1, 1),), (date(2024, 1, 7),)), dutch_public_holidays(spark, 2024, 2024)
    ).orderBy("ds").collect()
    assert [(r.day_of_week, r.week_of_year, r.is_public_holiday) for r in got] == [(0, 1, 1), (6, 1, 0)]


def test_forward_demand(rows):
    got = demand.forward_demand(series(rows, 10, lambda i: -5 if i == 1 else i)).orderBy("ds").collect()
    assert got[0].demand_7d == sum(range(2, 8))
    assert got[2].demand_7d == sum(range(3, 10))
    assert got[3].demand_7d is None and got[0].demand_14d is None
    assert got[1].y == 0


def test_models_learn_and_clip(rows, spark):
    stock = rows(KEY + ", stock_qty decimal(13,3), days_of_cover decimal(8,2)", ("1", "S", D(5), D(2)))
    holidays = dutch_public_holidays(spark, 2024, 2024)
    data = series(rows, 120, lambda i: 10 + i % 7)
    training = demand.m1_training_rows(data, holidays, stock, min_days=100)
    assert training.count() == 120 - 28
    models = demand.m1_train(training, config.TreeSettings(trees=3, depth=3, rate=0.5))
    inputs = demand.m1_scoring_rows(data, holidays, stock, date(2024, 5, 1))
    got = demand.m1_score(models, inputs).first()
    assert got.forecast_7d == pytest.approx(91, rel=0.1)
    assert got.forecast_7d < got.forecast_14d < got.forecast_28d
    with pytest.raises(NoRowsError):
        demand.m1_train(training.limit(0))
    raw = rows(KEY + ", raw_7d double, raw_14d double, raw_28d double", ("1", "S", -1.0, 0.0, 2.0))
    clipped = demand.clip_forecasts(raw).first()
    assert (clipped.forecast_7d, clipped.forecast_28d) == (0.0, 2.0)


FORECAST = KEY + ", forecast_7d double, forecast_14d double, forecast_28d double"


def test_forecast_error(rows):
    actuals = rows(
        KEY + ", actual_7d double, actual_14d double, actual_28d double", ("1", "A", 100.0, 0.0, 50.0)
    )
    got = demand.forecast_error(rows(FORECAST, ("1", "A", 90.0, 5.0, 100.0)), actuals).collect()
    assert [(r.horizon_days, r.mae, r.mae_share, r.passes) for r in got] == [
        (7, 10.0, 0.1, True),
        (14, 5.0, None, False),
        (28, 50.0, 1.0, False),
    ]
    unsold = demand.forecast_error(rows(FORECAST, ("1", "B", 100.0, 0.0, 0.0)), actuals).first()
    assert (unsold.mae, unsold.passes) == (100.0, False)


def test_short_history_takes_category_median(rows):
    forecasts = rows(FORECAST, *[("1", s, float(v), v * 2.0, v * 4.0) for s, v in (("A", 10), ("B", 20), ("C", 99))])
    days = rows(KEY + ", n_days long", ("1", "A", 20), ("1", "B", 20), ("1", "C", 3))
    categories = rows(KEY + ", category string", *[("1", s, "BAKERY") for s in "ABCD"], ("1", "E", "DRY"))
    got = {
        r.unified_sku_id: (r.forecast_7d, r.forecast_28d, r.is_fallback)
        for r in demand.short_history_fallback(forecasts, days, categories, 14).collect()
    }
    assert got == {
        "A": (10.0, 40.0, False),
        "B": (20.0, 80.0, False),
        "C": (15.0, 60.0, True),
        "D": (15.0, 60.0, True),
        "E": (None, None, True),
    }


def test_weather_rows(rows):
    body = {"daily": {"time": ["2024-01-01", "2024-01-02"], "temperature_2m_max": [5.5, None], "precipitation_sum": [None, 1.0]}}
    got = weather_rows(rows("body string", (json.dumps(body),))).collect()
    assert [tuple(r) for r in got] == [("2024-01-01", 5.5, None), ("2024-01-02", None, 1.0)]
    for name in body["daily"]:
        cut = {"daily": {k: v for k, v in body["daily"].items() if k != name}}
        with pytest.raises(Exception, match="lacks"):
            weather_rows(rows("body string", (json.dumps(cut),))).collect()


def test_weather_summary_and_lift(rows):
    weather = rows(
        "forecast_date string, temperature_max double, precipitation double",
        *[(f"2024-01-{i:02d}", None if i == 3 else 18.0, None if i < 5 else 4.0) for i in range(1, 29)],
    )
    summary = demand.weather_summary(weather)
    got = summary.first()
    assert got.temperature_delta == 3.0
    assert got.precipitation_delta == pytest.approx(12 / 7 - 2)
    lifts = rows("actual_lift double", (1.2,), (1.4,))
    model = demand.weather_train(
        demand.weather_training_rows(lifts, weather), config.TreeSettings(trees=2, depth=2, rate=0.1)
    )
    assert demand.weather_lift(model, summary).first().weather_lift == pytest.approx(1.3)
    with pytest.raises(NoRowsError):
        demand.weather_lift(model, demand.weather_summary(weather.limit(0)))
    clipped = demand.clip_lift(rows("v double", (0.1,), (1.1,), (9.0,)), "v").collect()
    assert [r.weather_lift for r in clipped] == [0.5, 1.1, 2.0]


def test_lifts(rows):
    forecasts = rows(FORECAST, ("1", "A", 100.0, 0.0, 0.0), ("1", "B", 0.2, 0.0, 0.0))
    actuals = rows(KEY + ", actual_7d decimal(13,3)", ("1", "A", D(130)), ("1", "B", D(9)))
    got = {r.unified_sku_id: r.actual_lift for r in demand.actual_lift(forecasts, actuals).collect()}
    assert got == {"A": 1.3, "B": 2.0}
    calendar = rows(KEY + ", baseline_demand double", ("1", "A", 130.0), ("1", "A", 65.0), ("1", "C", 1.0))
    promo = demand.promo_lift(forecasts, actuals, calendar).collect()
    assert [(r.unified_sku_id, r.promo_lift) for r in promo] == [("A", 1.5)]
    assert {r.promo_lift for r in demand.promo_lift(forecasts, actuals).collect()} == {1.0}


def test_corrected_forecast(rows):
    forecasts = rows(FORECAST, ("1", "A", 100.0, 200.0, 400.0), ("1", "B", 100.0, 200.0, -400.0))
    promo = rows(KEY + ", promo_lift double", ("1", "A", 1.3))
    got = {r.unified_sku_id: r for r in demand.m2_corrected(forecasts, promo, F.lit(1.0)).collect()}
    assert got["A"].corrected_7d == pytest.approx(130)
    assert (got["B"].corrected_7d, got["B"].corrected_28d, got["B"].promo_lift) == (100.0, 0.0, 1.0)
    assert demand.m2_corrected(forecasts, promo, F.lit(1.35)).filter("corrected_7d <= 100").count() == 0


def test_quantile_forecast_is_ordered(rows):
    corrected = rows(KEY + ", corrected_7d double", ("1", "A", 100.0), ("1", "B", 10.0), ("1", "C", 1.0))
    categories = rows(KEY + ", category string", ("1", "A", "X"), ("1", "B", "NEW"))
    quantiles = rows(
        "category string, residual_p10 double, residual_p50 double, residual_p90 double",
        ("X", -50.0, 0.0, 50.0),
        ("*", -20.0, 5.0, -1.0),
    )
    got = {
        r.unified_sku_id: (r.p10, r.p50, r.p90, r.uncertainty_spread)
        for r in demand.quantile_forecast(corrected, categories, quantiles).collect()
    }
    assert got == {
        "A": (50.0, 100.0, 150.0, 100.0),
        "B": (0.0, 9.0, 15.0, 15.0),
        "C": (0.0, 0.0, 6.0, 6.0),
    }
