"""Request documents as tables of sections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def document_sections(
    lines: DataFrame,
    key: str,
    heads: Sequence[tuple[str, Column]],
    item_section: str,
    item: Column,
) -> DataFrame:
    """Rows (key, section_no, section, payload): the heads of each document, then its lines.

    ``lines`` are numbered from 1 in ``_line``; the head sections are built from the key alone.
    """
    first = lines.select(key).distinct().select(
        key,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).cast("long").alias("section_no"),
                        F.lit(name).alias("section"),
                        F.to_json(body).alias("payload"),
                    )
                    for i, (name, body) in enumerate(heads, 1)
                ]
            )
        ),
    )
    items = lines.select(
        key,
        (F.col("_line") + len(heads)).cast("long").alias("section_no"),
        F.lit(item_section).alias("section"),
        F.to_json(item).alias("payload"),
    )
    return first.unionByName(items)
