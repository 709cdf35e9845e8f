"""Order quantities, shelf-life policy, approval and order requests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import config
from larder.functions.documents import document_sections
from larder.functions.grouping import numbered_within
from larder.functions.quantities import fixed_text, half_even, numbered
from larder.operators.phantom import SafetyCapExceeded

KEYS = list(config.KEYS)
LIMITS = config.OrderLimits()

AUTO_APPROVED = "AUTO_APPROVED"
PENDING_REVIEW = "PENDING_REVIEW"
BLOCKED = "BLOCKED"

_REQUIRED = [
    "p10",
    "p50",
    "p90",
    "stock_qty",
    "shelf_life_days",
    "transit_days",
    "unit_cost",
    "min_order_qty",
    "max_order_qty",
    "category",
    "truck_capacity_units",
]


def solver_inputs(
    quantiles: DataFrame, lifts: DataFrame, stock: DataFrame, master: DataFrame
) -> DataFrame:
    """Everything an order quantity depends on; incomplete rows drop out.

    All four tables share the key, so each is shuffled at most once.
    """
    return (
        quantiles.select(*KEYS, "p10", "p50", "p90")
        .join(lifts.select(*KEYS, "promo_lift", "weather_lift"), KEYS, "inner")
        .join(stock.select(*KEYS, "stock_qty"), KEYS, "inner")
        .join(
            master.select(
                *KEYS,
                "unit_cost",
                "transit_days",
                "min_order_qty",
                "max_order_qty",
                "category",
                "shelf_life_days",
                "truck_capacity_units",
            ),
            KEYS,
            "inner",
        )
        .dropna(subset=_REQUIRED)
        .withColumns(
            {
                **{c: F.col(c).cast("double") for c in ("p10", "p50", "p90", "unit_cost")},
                **{
                    c: F.col(c).cast("int")
                    for c in (
                        "stock_qty",
                        "shelf_life_days",
                        "transit_days",
                        "min_order_qty",
                        "max_order_qty",
                    )
                },
                "truck_capacity_units": F.col("truck_capacity_units").cast("double"),
            }
        )
    )


def transit_ratio() -> Column:
    """Share of the shelf life spent in transit; a shelf life below one day counts as one."""
    return F.col("transit_days") / F.greatest(F.col("shelf_life_days"), F.lit(1))


def order_quantity(inputs: DataFrame) -> DataFrame:
    """Smallest whole quantity that covers P90 demand within order and truck limits.

    The objective is the quantity itself, so the optimum is the lower bound whenever the
    bounds leave room.
    """
    need = F.greatest(F.col("p90") - F.col("stock_qty"), F.lit(0.0))
    least = F.greatest(F.col("min_order_qty").cast("long"), F.ceil(need))
    most = F.least(F.col("max_order_qty").cast("long"), F.floor("truck_capacity_units"))
    feasible = least <= most
    return inputs.withColumns(
        {
            "transit_to_life_ratio": transit_ratio(),
            "recommended_qty": F.when(feasible, least).otherwise(0).cast("int"),
            "solver_status": F.when(feasible, "Optimal").otherwise("Infeasible"),
            "blocked": F.lit(False),
        }
    )


def ttl_policy(sized: DataFrame, limits: config.OrderLimits = LIMITS) -> DataFrame:
    """Shelf-life policy: pass, shrink to the remaining life, or block."""

    def by_category(pick) -> Column:
        rules = list(limits.life_rules.items())
        chosen = F.when(F.col("category") == rules[0][0], F.lit(pick(rules[0][1])))
        for category, rule in rules[1:]:
            chosen = chosen.when(F.col("category") == category, F.lit(pick(rule)))
        return chosen.otherwise(F.lit(pick(limits.default_life_rule)))

    ratio = F.col("transit_to_life_ratio")
    capped = F.greatest(half_even(F.col("recommended_qty") * (1.0 - ratio)), F.lit(0)).cast("int")
    applied = (
        F.when(ratio <= by_category(lambda r: r.limit), "PASS")
        .when(by_category(lambda r: r.hard) | (F.col("_capped") == 0), "HARD_BLOCK")
        .otherwise("SOFT_CAP")
    )
    is_block = F.col("ttl_policy_applied") == "HARD_BLOCK"
    is_cap = F.col("ttl_policy_applied") == "SOFT_CAP"
    return (
        sized.withColumn("_capped", capped)
        .withColumn("ttl_policy_applied", applied)
        .withColumns(
            {
                "recommended_qty": F.when(is_block, 0)
                .when(is_cap, F.col("_capped"))
                .otherwise(F.col("recommended_qty")),
                "blocked": F.col("blocked") | is_block,
                "solver_status": F.when(is_block, "BLOCKED_TRANSIT_TO_LIFE").otherwise(
                    F.col("solver_status")
                ),
                "day_old_discount": is_cap,
            }
        )
        .drop("_capped")
    )


def approval_gate(rows: DataFrame, limits: config.OrderLimits = LIMITS) -> DataFrame:
    """Which orders go out on their own, and why the others do not."""
    open_ = ~F.col("blocked")
    ratio = F.when(F.col("p50") > 0, (F.col("p90") - F.col("p10")) / F.col("p50")).otherwise(0.0)
    value = F.col("recommended_qty") * F.col("unit_cost")
    unsure = F.col("confidence_ratio") >= limits.uncertainty_ratio
    costly = F.col("order_value") >= limits.order_value
    reasons = F.concat_ws(
        "; ",
        F.when(
            open_ & unsure,
            F.concat(F.lit("HIGH_UNCERTAINTY: ratio="), fixed_text(F.col("confidence_ratio"), 3)),
        ),
        F.when(
            open_ & costly,
            F.concat(F.lit("HIGH_VALUE: €"), fixed_text(F.col("order_value"), 2)),
        ),
    )
    return rows.withColumns(
        {
            "confidence_ratio": F.when(open_, ratio).otherwise(0.0),
            "order_value": F.when(open_, value).otherwise(0.0),
        }
    ).withColumns(
        {
            "approval_status": F.when(F.col("blocked"), BLOCKED)
            .when(unsure | costly, PENDING_REVIEW)
            .otherwise(AUTO_APPROVED),
            "approval_reason": F.when(open_ & (unsure | costly), reasons),
        }
    )


def solver_output(inputs: DataFrame, limits: config.OrderLimits = LIMITS) -> DataFrame:
    """Quantity, policy and approval of every input row, in the output layout."""
    decided = approval_gate(ttl_policy(order_quantity(inputs), limits), limits)
    return decided.select(
        F.col("unified_sku_id").alias("sku_id"),
        F.col("werks").alias("site_id"),
        "recommended_qty",
        "transit_to_life_ratio",
        "blocked",
        "solver_status",
        "approval_status",
        "approval_reason",
        "confidence_ratio",
        "order_value",
        "ttl_policy_applied",
        "day_old_discount",
        F.coalesce("promo_lift", F.lit(1.0)).alias("promo_lift"),
        F.coalesce("weather_lift", F.lit(1.0)).alias("weather_lift"),
    )


def order_recommendations(output: DataFrame, quantiles: DataFrame) -> DataFrame:
    """Solver output next to the demand quantiles it was made from."""
    spread = quantiles.select(*KEYS, "p10", "p50", "p90", "uncertainty_spread")
    return (
        output.withColumnsRenamed({"sku_id": "unified_sku_id", "site_id": "werks"})
        .join(spread, KEYS, "left")
        .select(
            *KEYS,
            "recommended_qty",
            "transit_to_life_ratio",
            "approval_status",
            "approval_reason",
            "confidence_ratio",
            "order_value",
            "ttl_policy_applied",
            "day_old_discount",
            "solver_status",
            "p10",
            "p50",
            "p90",
            "uncertainty_spread",
            "promo_lift",
            "weather_lift",
        )
    )


def recommendation_metrics(recommendations: DataFrame) -> DataFrame:
    """Counts per status and the value that goes out automatically, in one pass."""
    status = F.col("approval_status")
    return recommendations.agg(
        F.count_if(status == AUTO_APPROVED).alias("auto_approved_count"),
        F.count_if(status == PENDING_REVIEW).alias("pending_review_count"),
        F.count_if(status == BLOCKED).alias("blocked_count"),
        F.coalesce(
            F.sum(F.when(status == AUTO_APPROVED, F.col("order_value").cast("decimal(20,6)"))),
            F.lit(0),
        )
        .cast("double")
        .alias("total_order_value_eur"),
    )


def recommendations_by_site(
    recommendations: DataFrame, site_id: str | None = None, run_date: dt.date | None = None
) -> DataFrame:
    """Recommendations of a site, of a run date, or of both."""
    rows = recommendations
    if site_id is not None:
        rows = rows.filter(F.col("werks") == site_id)
    if run_date is not None:
        rows = rows.filter(F.col("run_date") == F.lit(run_date))
    return rows.select(
        F.col("unified_sku_id").alias("sku_id"),
        F.col("werks").alias("site_id"),
        "recommended_qty",
        "transit_to_life_ratio",
        (F.col("approval_status") == BLOCKED).alias("blocked"),
        F.date_format("run_date", "yyyy-MM-dd").alias("run_date"),
    )


def po_candidates(recommendations: DataFrame) -> DataFrame:
    """Recommendations that become orders without a person."""
    return recommendations.filter(
        (F.col("approval_status") == AUTO_APPROVED) & (F.col("recommended_qty") > 0)
    )


def orders_within_cap(candidates: DataFrame, cap: int = LIMITS.max_orders) -> DataFrame:
    """One row: number of automatic orders, the cap, and whether they may go out."""
    return candidates.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(cap).alias("cap"), (F.col("n_rows") <= cap).alias("within_cap")
    )


def po_cap(candidates: DataFrame, cap: int = LIMITS.max_orders) -> DataFrame:
    """The candidates, or an error before any of them is emitted."""
    if candidates.limit(cap + 1).count() > cap:
        raise SafetyCapExceeded(f"more than {cap} automatic orders in one run")
    return candidates


def po_requests(rows: DataFrame) -> DataFrame:
    """One order request per row."""
    body = F.struct(
        F.struct(
            F.col("werks").alias("COMP_CODE"), F.lit(config.ORDER_DOC_TYPE).alias("DOC_TYPE")
        ).alias("POHEADER"),
        F.array(
            F.struct(
                F.col("unified_sku_id").alias("MATERIAL"),
                F.col("werks").alias("PLANT"),
                F.col("recommended_qty").alias("QUANTITY"),
                F.lit(config.ORDER_UNIT).alias("UNIT"),
            )
        ).alias("POITEM"),
    )
    return rows.select(*KEYS, "recommended_qty", "approval_status", F.to_json(body).alias("payload"))


def po_requests_batched(rows: DataFrame, delivery_date: Column) -> DataFrame:
    """One order document per vendor as rows: header, partner, and items numbered from 1.

    A document is a table of its sections in the order of ``section_no``, so a vendor with
    any number of lines has one document and nothing is gathered.
    """
    placed = numbered_within(
        rows.withColumn("vendor_id", F.coalesce("vendor_id", F.lit("UNKNOWN"))).withColumn(
            "_delivery", F.date_format(delivery_date, "yyyyMMdd")
        ),
        "vendor_id",
        "unified_sku_id",
        ["werks", "recommended_qty"],
        "_line",
    )
    line = F.struct(
        numbered(F.col("_line"), 5).alias("PO_ITEM"),
        F.col("unified_sku_id").alias("MATERIAL"),
        F.col("werks").alias("PLANT"),
        F.col("recommended_qty").cast("double").alias("QUANTITY"),
        F.lit(config.ORDER_UNIT).alias("PO_UNIT"),
        F.col("_delivery").alias("DELIV_DATE"),
    )
    header = F.struct(
        F.lit(config.ORDER_DOC_TYPE).alias("DOC_TYPE"), F.lit("").alias("CREAT_DATE")
    )
    partner = F.struct(
        F.lit(config.PARTNER_LANGUAGE).alias("LANGU"),
        F.col("vendor_id").alias("BUSN_PARTNR"),
        F.lit(config.PARTNER_ROLE).alias("PART_ROLE"),
    )
    return document_sections(
        placed, "vendor_id", (("POHEADER", header), ("POPARTNER", partner)), "POITEM", line
    )


# Fixed value: fields of an order or movement response that matter
RESPONSE = (
    "PO_NUMBER string, EXPPURCHASEORDER string, POHDR struct<EBELN: string>, "
    "MATERIALDOCUMENT string, RETURN array<struct<TYPE: string, MESSAGE: string>>"
)


def po_confirmations(responses: DataFrame, body: str = "response") -> DataFrame:
    """Document number, success and messages of every response.

    The number travels under one of several names. A readable response succeeds unless one
    of its return entries is an error. An empty answer counts as done, without a number
    (orders also need the number, see ``po_audit``). No answer (NULL) and an answer that is
    not a JSON object are failures with their own message.
    """
    parsed = responses.withColumn(
        "_r",
        F.from_json(F.col(body), f"{RESPONSE}, _unreadable string", {"columnNameOfCorruptRecord": "_unreadable"}),
    )
    text = F.trim(F.col(body), F.lit(" \t\r\n"))
    problem = (
        F.when(F.col(body).isNull(), "no answer")
        .when(text == "", F.lit(None))
        .when(~text.startswith("{") | F.col("_r").isNull() | F.col("_r._unreadable").isNotNull(), "unreadable answer")
    )
    none = F.array().cast("array<struct<TYPE:string,MESSAGE:string>>")
    failed = F.array(F.struct(F.lit("E").alias("TYPE"), problem.alias("MESSAGE")))
    entries = F.when(problem.isNotNull(), failed).otherwise(F.coalesce(F.col("_r.RETURN"), none))
    return (
        parsed.withColumn(
            "document_number",
            F.coalesce(
                "_r.PO_NUMBER",
                "_r.EXPPURCHASEORDER",
                "_r.POHDR.EBELN",
                "_r.MATERIALDOCUMENT",
                F.lit(""),
            ),
        )
        .withColumn(
            "success", ~F.exists(entries, lambda e: F.coalesce(e["TYPE"] == "E", F.lit(False)))
        )
        .withColumn("messages", F.transform(entries, lambda e: F.coalesce(e["MESSAGE"], F.lit(""))))
        .drop("_r", body)
    )


def po_audit(requests: DataFrame, confirmations: DataFrame) -> DataFrame:
    """What became of every decided row: ok, error, or skipped when no order was wanted.

    ``requests`` may carry ``needs_order``; rows without the column all want an order.
    """
    wanted = F.col("needs_order") if "needs_order" in requests.columns else F.lit(True)
    answered = confirmations.select(*KEYS, "document_number", "success", "messages")
    ok = wanted & F.coalesce("success", F.lit(False)) & (F.col("document_number") != "")
    return (
        requests.withColumn("_wanted", wanted)
        .join(answered, KEYS, "left")
        .withColumn("_ok", F.coalesce(ok, F.lit(False)))
        .select(
            *KEYS,
            "recommended_qty",
            "approval_status",
            F.when(~F.col("_wanted"), "skipped")
            .when(F.col("_ok"), "ok")
            .otherwise("error")
            .alias("bapi_status"),
            F.when(F.col("_ok"), F.col("document_number")).alias("po_number"),
            F.when(
                F.col("_wanted") & ~F.col("_ok"),
                F.coalesce(
                    F.nullif(F.array_join("messages", "; "), F.lit("")), F.lit("no confirmation")
                ),
            ).alias("bapi_message"),
        )
    )
