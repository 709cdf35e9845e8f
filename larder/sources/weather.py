"""Weather forecast bodies: one JSON text with parallel arrays becomes one row per day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: shape of a forecast body
FORECAST_BODY = (
    "struct<daily: struct<time: array<string>, temperature_2m_max: array<double>, "
    "precipitation_sum: array<double>>>"
)


def weather_rows(bodies: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per forecast day; missing measurements stay NULL, a missing array is an error."""
    daily = F.from_json(F.col(body), FORECAST_BODY)["daily"]
    parts = {n: daily[n] for n in ("time", "temperature_2m_max", "precipitation_sum")}
    complete = parts["time"].isNotNull()
    for name in ("temperature_2m_max", "precipitation_sum"):
        complete = complete & parts[name].isNotNull()
    checked = F.when(complete, F.arrays_zip(*parts.values())).otherwise(
        F.raise_error(F.lit("forecast body lacks time, temperature or precipitation"))
    )
    days = bodies.select(*keep, F.explode(checked).alias("_day"))
    return days.select(
        *keep,
        F.col("_day.time").alias("forecast_date"),
        F.col("_day.temperature_2m_max").alias("temperature_max"),
        F.col("_day.precipitation_sum").alias("precipitation"),
    )
