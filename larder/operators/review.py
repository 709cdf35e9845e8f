"""Exception review: listing, identities, decisions, explanations and store status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import config

KEYS = list(config.KEYS)
QUEUE_KEY = [*KEYS, "_loaded_at"]


def exception_status(decision: Column) -> Column:
    """Status shown to reviewers."""
    return F.when(decision == "APPROVED", "APPROVED").when(decision == "REJECTED", "BLOCKED").otherwise(
        "PENDING"
    )


def exception_id(
    werks: Column | str = "werks",
    sku: Column | str = "unified_sku_id",
    loaded_at: Column | str = "_loaded_at",
) -> Column:
    return F.concat_ws("|", werks, sku, loaded_at)


def parse_exception_id(ident: Column) -> Column:
    """Site, SKU and load time of an id, cut at its first two bars; fewer bars are an error."""
    parts = F.split(ident, r"\|", 3)
    return F.when(
        F.size(parts) == 3,
        F.struct(
            parts[0].alias("werks"), parts[1].alias("unified_sku_id"), parts[2].alias("_loaded_at")
        ),
    ).otherwise(F.raise_error(F.concat(F.lit("not an exception id: "), ident)))


def _items(queue: DataFrame) -> DataFrame:
    return queue.withColumn("exception_id", exception_id()).withColumn(
        "status", exception_status(F.col("manager_decision"))
    )


def list_exceptions(
    queue: DataFrame, status: str = "PENDING", store_id: str | None = None
) -> DataFrame:
    """Escalated rows in a status, largest deviation first."""
    stored = "REJECTED" if status == "BLOCKED" else status
    rows = queue.filter(
        (F.col("sweeper_action") == "ESCALATE")
        & (F.coalesce("manager_decision", F.lit("PENDING")) == stored)
    )
    if store_id is not None:
        rows = rows.filter(F.col("werks") == store_id)
    return _items(rows).orderBy(F.col("quantity_deviation_pct").desc(), "exception_id")


def get_exception(queue: DataFrame, ident: str) -> DataFrame:
    """The row of one id; the filter on the key columns reaches the scan."""
    parts = ident.split("|", 2)
    if len(parts) != 3:
        raise ValueError(f"not an exception id: {ident!r}")
    werks, sku, loaded_at = parts
    return _items(
        queue.filter(
            (F.col("werks") == werks)
            & (F.col("unified_sku_id") == sku)
            & (F.col("_loaded_at") == loaded_at)
        )
    )


def apply_decisions(queue: DataFrame, decisions: DataFrame) -> DataFrame:
    """Queue with its present decisions.

    Decisions are appended to a log; the latest one per row counts. Of decisions with equal
    times a rejection counts before an approval, then the last manager by name. A rejection
    leaves the override of an earlier approval in place.
    """
    timed = F.col("decision_timestamp").isNotNull()
    decided = F.when(
        timed,
        F.struct("decision_timestamp", "manager_decision", "manager_id", "override_reason", "override_qty"),
    )
    approved = F.col("manager_decision") == "APPROVED"
    latest = decisions.groupBy(*QUEUE_KEY).agg(
        F.max_by(F.struct("manager_decision", "manager_id", "decision_timestamp"), decided).alias(
            "_last"
        ),
        F.max_by(
            F.struct("override_reason", "override_qty"), F.when(approved, decided)
        ).alias("_override"),
    )
    joined = queue.join(latest, QUEUE_KEY, "left")
    changed = F.col("_last").isNotNull()
    current = {
        c: F.when(changed, F.col(f"_last.{c}")).otherwise(F.col(c))
        for c in ("manager_decision", "manager_id", "decision_timestamp")
    }
    overridden = F.col("_override").isNotNull()
    current |= {
        c: F.when(overridden, F.col(f"_override.{c}")).otherwise(F.col(c))
        for c in ("override_reason", "override_qty")
    }
    return joined.withColumns(current).select(*queue.columns)


def ranked_contributions(queue: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Explanation entries of every row, strongest first; rows without entries vanish.

    Equal strengths keep their order in the text.
    """
    columns = QUEUE_KEY if keep is None else keep
    entries = F.map_entries(F.from_json("shap_values", "map<string,double>"))
    strongest = F.array_sort(
        entries,
        lambda a, b: F.when(F.abs(a["value"]) > F.abs(b["value"]), -1)
        .when(F.abs(a["value"]) < F.abs(b["value"]), 1)
        .otherwise(0),
    )
    return queue.select(*columns, F.posexplode(strongest).alias("_pos", "_entry")).select(
        *columns,
        (F.col("_pos") + 1).alias("rank"),
        F.col("_entry.key").alias("feature"),
        F.col("_entry.value").alias("contribution"),
        F.when(F.col("_entry.value") >= 0, "positive").otherwise("negative").alias("sign"),
    )


def new_since_poll(items: DataFrame, seen: DataFrame) -> DataFrame:
    """Items whose id an earlier poll has not returned."""
    return items.join(seen.select("exception_id"), "exception_id", "left_anti")


def pending_count(items: DataFrame) -> DataFrame:
    return items.agg(F.count_if(F.col("status") == "PENDING").alias("pending_count"))


def store_status(queue: DataFrame, released: DataFrame) -> DataFrame:
    """Per store: no-touch rate, open exceptions, release flag and traffic light.

    ``released`` lists the stores whose orders went out.
    """
    pending = (F.col("sweeper_action") == "ESCALATE") & (
        exception_status(F.col("manager_decision")) == "PENDING"
    )
    sites = released.select("werks").distinct().withColumn("_released", F.lit(True))
    return (
        queue.groupBy("werks")
        .agg(
            (F.count_if(F.col("sweeper_action") == "AUTO_APPROVE") / F.count(F.lit(1))).alias(
                "no_touch_rate"
            ),
            F.count_if(pending).alias("exceptions_pending"),
        )
        .join(sites, "werks", "left")
        .withColumn("edi_released", F.coalesce("_released", F.lit(False)))
        .withColumn(
            "colour",
            F.when(~F.col("edi_released"), "red")
            .when(F.col("exceptions_pending") > 0, "amber")
            .otherwise("green"),
        )
        .drop("_released")
    )
