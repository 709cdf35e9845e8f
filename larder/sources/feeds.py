"""The three ERP change feeds: schemas, keys and targets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(*fields: tuple[str, DataType]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


_TEXT, _DAY, _QTY = StringType(), DateType(), DecimalType(13, 3)

# --- Fixed values: column names and types of the feeds -----------------------------
MATERIALS = _schema(
    ("MATNR", _TEXT),
    ("EAN11", _TEXT),
    ("WERKS", _TEXT),
    ("MAKTX", _TEXT),
    ("MTART", _TEXT),
    ("MATKL", _TEXT),
    ("MEINS", _TEXT),
    ("MHDRZ", DecimalType(5, 0)),
    ("IPRKZ", _TEXT),
    ("MHDLP", DecimalType(5, 0)),
    ("LAEDA", _DAY),
    ("ERSDA", _DAY),
)
INVENTORY = _schema(
    ("MBLNR", _TEXT),
    ("ZEILE", _TEXT),
    ("MATNR", _TEXT),
    ("WERKS", _TEXT),
    ("LGORT", _TEXT),
    ("BWART", _TEXT),
    ("MENGE", _QTY),
    ("MEINS", _TEXT),
    ("BUDAT", _DAY),
    ("CPUDT", _DAY),
    ("CPUTM", TimestampType()),
)
OPEN_ORDERS = _schema(
    ("EBELN", _TEXT),
    ("EBELP", _TEXT),
    ("MATNR", _TEXT),
    ("WERKS", _TEXT),
    ("LIFNR", _TEXT),
    ("MENGE", _QTY),
    ("MEINS", _TEXT),
    ("NETPR", DecimalType(11, 2)),
    ("WAERS", _TEXT),
    ("EINDT", _DAY),
    ("BEDAT", _DAY),
    ("EKORG", _TEXT),
    ("EKGRP", _TEXT),
)


@dataclass(frozen=True)
class Feed:
    name: str
    schema: StructType
    keys: tuple[str, ...]
    folder: str

    @property
    def target(self) -> str:
        return f"bronze/{self.folder}"


FEEDS = {
    f.name: f
    for f in (
        Feed("materials", MATERIALS, ("MATNR", "WERKS"), "materials"),
        Feed("inventory", INVENTORY, ("MBLNR", "ZEILE"), "inventory"),
        Feed("open_orders", OPEN_ORDERS, ("EBELN", "EBELP"), "open_orders"),
    )
}


def conform(df: DataFrame, feed: Feed) -> DataFrame:
    """Selects the columns of a feed in order and in type; absent columns become NULL."""
    present = {c.upper(): c for c in df.columns}
    return df.select(
        *[
            (F.col(present[f.name.upper()]) if f.name.upper() in present else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in feed.schema.fields
        ]
    )


def join_header_item(items: DataFrame, headers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Item rows with the columns of their document header; items without a header drop out.

    Where both sides carry a column, the item's one is kept.
    """
    extra = [c for c in headers.columns if c in keys or c not in items.columns]
    return items.join(headers.select(*extra), list(keys), "inner")
