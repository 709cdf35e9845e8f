"""X12 850 purchase-order documents, one per vendor.

A document is a table of segments. No vendor's lines are gathered into one value, so a
vendor with a third of all lines is numbered, rendered and written by many tasks.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import config
from larder.functions.grouping import numbered_within
from larder.functions.quantities import padded, plain_number_text

UNKNOWN_VENDOR = "UNKNOWN"


def edi_lines(consolidated: DataFrame, day: dt.date) -> DataFrame:
    """Order lines numbered per vendor by SKU, site and order number."""
    ship = F.date_add(F.lit(day), F.coalesce(F.col("transit_days").cast("int"), F.lit(0)))
    rows = consolidated.select(
        F.coalesce(F.nullif("vendor_id", F.lit("")), F.lit(UNKNOWN_VENDOR)).alias("vendor_id"),
        F.coalesce("unified_sku_id", F.lit("")).alias("unified_sku_id"),
        "werks",
        "po_number",
        F.coalesce("ean_barcode", F.lit("")).alias("ean_barcode"),
        F.col("recommended_qty").alias("quantity"),
        F.lit(config.ORDER_UNIT).alias("unit"),
        F.coalesce(F.col("unit_cost").cast("double"), F.lit(0.0)).alias("unit_price"),
        F.date_format(ship, "yyyyMMdd").alias("requested_ship_date"),
    )
    return numbered_within(
        rows, "vendor_id", "unified_sku_id", ["werks", "po_number"], "line_number"
    ).select(
        "vendor_id",
        "line_number",
        "po_number",
        "ean_barcode",
        "quantity",
        "unit",
        "unit_price",
        "requested_ship_date",
    )


def edi_files(lines: DataFrame, timestamp: str) -> DataFrame:
    """One row per vendor: first order, number of lines and file name."""
    return (
        lines.groupBy("vendor_id")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.max(F.when(F.col("line_number") == 1, F.col("po_number"))).alias("first_po"),
        )
        .withColumn(
            "edi_file", F.concat(F.lit("EDI850_"), F.col("first_po"), F.lit(f"_{timestamp}.edi"))
        )
    )


def _joined(*parts: str | Column) -> Column:
    """Elements of a segment with their separator."""
    return F.concat_ws("*", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def edi_documents(
    lines: DataFrame, sender_id: str, timestamp: str, files: DataFrame | None = None
) -> DataFrame:
    """All segments of all documents: ``vendor_id``, ``edi_file``, ``segment_no``, ``segment``.

    Joining the segments of a vendor by line feeds in the order of their number gives the
    document. ``timestamp`` is ``yyyyMMddHHmmss``; its last nine digits are the control
    number. The declared segment count includes the two interchange segments.
    """
    if files is None:
        files = edi_files(lines, timestamp)
    day, minute, control = timestamp[:8], timestamp[8:12], timestamp[-9:]
    sender = F.lit(sender_id)
    vendor = F.col("vendor_id")
    text = F.col("n_lines").cast("string")
    declared = (2 * F.col("n_lines") + 6).cast("string")
    blank = " " * 10

    # Segments and elements of the document frame
    frame = [
        _joined(
            "ISA", "00", blank, "00", blank, "ZZ", padded(sender, 15), "ZZ", padded(vendor, 15),
            day, minute, "^", "00501", control, "0", "P", ":",
        ),
        _joined("GS", "PO", sender, vendor, day, minute, "1", "X", "005010"),
        _joined("ST", "850", "0001"),
        _joined("BEG", "00", "NE", F.coalesce("first_po", F.lit("None")), "", day),
        _joined("CTT", text),
        _joined("SE", declared, "0001"),
        _joined("GE", "1", "1"),
        _joined("IEA", "1", control),
    ]
    leading = 4
    body_end = F.lit(leading) + 2 * F.col("n_lines")
    frame_rows = F.array(
        *[
            F.struct(
                (F.lit(i) if i <= leading else body_end + (i - leading))
                .cast("long")
                .alias("segment_no"),
                segment.alias("segment"),
            )
            for i, segment in enumerate(frame, start=1)
        ]
    )
    first = leading + 2 * (F.col("line_number") - 1)
    line_rows = F.array(
        F.struct(
            (first + 1).cast("long").alias("segment_no"),
            _joined(
                "PO1",
                F.col("line_number").cast("string"),
                F.col("quantity").cast("string"),
                F.col("unit"),
                plain_number_text(F.col("unit_price")),
                "",
                "UP",
                F.col("ean_barcode"),
            ).alias("segment"),
        ),
        F.struct(
            (first + 2).cast("long").alias("segment_no"),
            _joined("DTM", "010", F.col("requested_ship_date")).alias("segment"),
        ),
    )
    named = lines.join(files.select("vendor_id", "edi_file"), "vendor_id", "inner")
    columns = ["vendor_id", "edi_file"]
    return named.select(*columns, F.inline(line_rows)).unionByName(
        files.select(*columns, F.inline(frame_rows))
    )


_ORDER = ("vendor_id", "edi_file", "segment_no")


def edi_sink(documents: DataFrame, folder: str) -> None:
    """Writes all documents as one table, ranged and sorted by vendor, file and segment.

    The number of files follows the data, not the number of vendors, and a large document
    spans several of them. ``edi_hand_over`` makes the files of a vendor from it.
    """
    documents.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).write.mode("overwrite").parquet(folder)


def edi_hand_over(documents: DataFrame, folder: str) -> None:
    """Writes documents as text below ``folder``, as ``vendor_id=.../edi_file=...``.

    Meant for the vendors of one transfer: the commit of the folders takes time with their
    number. The vendor is part of the path because vendors may share a first order number
    and with it a file name. A large document spans several part files whose names sort in
    segment order, so their concatenation is the document.
    """
    (
        documents.repartitionByRange(*_ORDER)
        .sortWithinPartitions(*_ORDER)
        .select("vendor_id", "edi_file", F.col("segment").alias("value"))
        .write.mode("overwrite")
        .partitionBy("vendor_id", "edi_file")
        .text(folder)
    )
