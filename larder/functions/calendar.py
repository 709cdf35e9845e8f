"""Public holidays of the Netherlands, from their rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _easter(year: Column) -> Column:
    """Gregorian Easter Sunday (anonymous algorithm)."""
    golden = year % 19
    century = F.floor(year / 100)
    rest = year % 100
    epact = (
        19 * golden
        + century
        - F.floor(century / 4)
        - F.floor((century - F.floor((century + 8) / 25) + 1) / 3)
        + 15
    ) % 30
    weekday = (32 + 2 * (century % 4) + 2 * F.floor(rest / 4) - epact - rest % 4) % 7
    shift = F.floor((golden + 11 * epact + 22 * weekday) / 451)
    day_of_march = epact + weekday - 7 * shift + 22
    return F.date_add(F.make_date(year, F.lit(3), F.lit(1)), (day_of_march - 1).cast("int"))


def dutch_public_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """One row per holiday. The size depends on the number of years only."""
    years = spark.range(first_year, last_year + 1, numPartitions=1).select(
        F.col("id").cast("int").alias("year")
    )
    year = F.col("year")
    easter = F.col("easter")

    def fixed(month: int, day: int) -> Column:
        return F.make_date(year, F.lit(month), F.lit(day))

    def not_sunday(day: Column) -> Column:
        return F.when(F.weekday(day) == 6, F.date_sub(day, 1)).otherwise(day)

    royal = F.when(year >= 2014, not_sunday(fixed(4, 27))).otherwise(not_sunday(fixed(4, 30)))
    liberation = F.when(year % 5 == 0, fixed(5, 5))
    days = F.array(
        fixed(1, 1),
        easter,
        F.date_add(easter, 1),
        royal,
        liberation,
        F.date_add(easter, 39),
        F.date_add(easter, 49),
        F.date_add(easter, 50),
        fixed(12, 25),
        fixed(12, 26),
    )
    return (
        years.withColumn("easter", _easter(year))
        .select(F.explode(days).alias("holiday_date"))
        .filter(F.col("holiday_date").isNotNull())
        .distinct()
    )
