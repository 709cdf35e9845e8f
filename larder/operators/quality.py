"""Row expectations: drop or report, with counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _holds(condition: str | Column) -> Column:
    column = F.expr(condition) if isinstance(condition, str) else condition
    return F.coalesce(column, F.lit(False))


def expect_or_drop(
    df: DataFrame, name: str, condition: str | Column, observed: Observation | None = None
) -> DataFrame:
    """Keeps rows that satisfy the condition; NULL counts as a failure.

    Pass an ``Observation`` to receive ``<name>_passed`` and ``<name>_dropped`` from the
    action that runs the plan, without a second pass.
    """
    holds = _holds(condition)
    if observed is not None:
        df = df.observe(
            observed,
            F.count_if(holds).alias(f"{name}_passed"),
            F.count_if(~holds).alias(f"{name}_dropped"),
        )
    return df.filter(holds)


def expect_warn(
    df: DataFrame, name: str, condition: str | Column, observed: Observation
) -> DataFrame:
    """Keeps every row and counts failures into the observation."""
    return df.observe(observed, F.count_if(~_holds(condition)).alias(f"{name}_failed"))


def expectation_report(df: DataFrame, expectations: dict[str, str | Column]) -> DataFrame:
    """One row per expectation with passed and failed counts, in a single pass."""
    totals = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(_holds(c)).alias(n) for n, c in expectations.items()],
    )
    entries = [F.struct(F.lit(n).alias("n"), F.col(n).alias("passed")) for n in expectations]
    return totals.select("_rows", F.explode(F.array(*entries)).alias("_e")).select(
        F.col("_e.n").alias("expectation"),
        F.col("_e.passed").alias("passed"),
        (F.col("_rows") - F.col("_e.passed")).alias("failed"),
    )

