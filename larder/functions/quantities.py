"""Column expressions for quantities, ratios and their text form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder import config

QUANTITY = "decimal(13,3)"


def _zero() -> Column:
    return F.lit(0).cast(QUANTITY)


def signed_quantity(code: str = "BWART", quantity: str = "MENGE") -> Column:
    """Effect of a movement on stock: receipts add, issues subtract, other codes do nothing."""
    return (
        F.when(F.col(code).isin(*config.STOCK_IN), F.col(quantity))
        .when(F.col(code).isin(*config.STOCK_OUT), -F.col(quantity))
        .otherwise(_zero())
    )


def sale_quantity(code: str = "BWART", quantity: str = "MENGE") -> Column:
    """Effect of a movement on sales: sales add, customer returns subtract."""
    return (
        F.when(F.col(code) == config.SALE, F.col(quantity))
        .when(F.col(code) == config.SALE_RETURN, -F.col(quantity))
        .otherwise(_zero())
    )


def guarded_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, NULL where ``bottom`` is zero (ANSI division would fail the job)."""
    return F.when(bottom != 0, top / bottom)


def clipped(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Keeps a value inside a range; NULL stays NULL."""
    out = value
    if low is not None:
        out = F.when(out < low, F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(out > high, F.lit(high)).otherwise(out)
    return out


def half_even(value: Column) -> Column:
    """Nearest whole number, halves to the even neighbour."""
    return F.bround(value, 0)


def fixed_text(value: Column, digits: int) -> Column:
    """A non-negative double with ``digits`` decimals, rounded from its exact binary value.

    ``format_string`` rounds the shortest decimal form half up, so 0.3125 and 675.075 come
    out differently from C and Python. Only a scaled value that lands on exactly .5 is in
    doubt: there the rounding error of the scaling (exact, by splitting the factor in two
    halves) tells on which side the true value lies, and a true half goes to even.
    """
    scale = float(10**digits)
    scaled = value * scale
    whole = F.floor(scaled).cast("double")
    rest = scaled - whole
    spread = value * 134217729.0
    high = spread - (spread - value)
    low = value - high
    error = (high * scale - scaled) + low * scale
    nearest = (
        F.when(rest > 0.5, whole + 1)
        .when(rest < 0.5, whole)
        .when(error > 0, whole + 1)
        .when(error < 0, whole)
        .otherwise(whole + (whole % 2))
    )
    shifted = nearest.cast("decimal(30,0)") * F.lit(f"{10.0 ** -digits:.{digits}f}").cast(
        f"decimal({digits + 1},{digits})"
    )
    return shifted.cast(f"decimal(36,{digits})").cast("string")


def plain_number_text(value: Column) -> Column:
    """A double as plain decimal text: shortest digits, no exponent, at least one decimal."""
    size = F.abs(value)
    wide = F.regexp_replace(
        value.cast("decimal(38,9)").cast("string"), r"^(-?\d+\.\d+?)0*$", "$1"
    )
    plain = (size == 0) | ((size >= 1e-3) & (size < 1e7))
    return F.when(plain, value.cast("string")).otherwise(wide)


def padded(value: Column, width: int) -> Column:
    """Right-padded with blanks; longer values stay whole."""
    return F.when(F.length(value) >= width, value).otherwise(F.rpad(value, width, " "))


def numbered(value: Column, width: int) -> Column:
    """Left-padded with zeros; longer numbers stay whole."""
    text = value.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))
