"""Missing values, lenient casts, money and price bands.

Raw records mark "missing" with null, an empty string, zero or NaN alike, so plain
``coalesce`` is not enough: the helpers here say which of these count as missing.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,4)"


def blank_to_null(c: Column) -> Column:
    """Null for an empty string; other values unchanged."""
    return F.when(F.length(c) > 0, c)


def first_filled(*cols: Column) -> Column:
    """The first string that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def nonzero(c: Column) -> Column:
    """Null for zero; other numbers unchanged."""
    return F.when(c != 0, c)


def safe_float(c: Column) -> Column:
    """Double, with unparseable text and NaN as null."""
    return F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))


def safe_int(c: Column) -> Column:
    """Whole part of a number or numeric text, else null."""
    return safe_float(c).try_cast("bigint")


# Spellings of booleans in re-read text files.
TRUE_WORDS = ["true", "1", "yes", "t", "y"]
FALSE_WORDS = ["false", "0", "no", "f", "n"]
NULL_WORDS = ["", "nan", "none", "null"]


def safe_bool(c: Column, numeric: bool = False) -> Column:
    """Tri-state boolean from a boolean or text column (``numeric``: from a number)."""
    if numeric:
        return F.nanvl(c.cast("double"), F.lit(None).cast("double")) != 0
    word = F.lower(F.trim(c.cast("string")))
    return (
        F.when(word.isNull() | word.isin(NULL_WORDS), F.lit(None).cast("boolean"))
        .when(word.isin(TRUE_WORDS), True)
        .when(word.isin(FALSE_WORDS), False)
        .otherwise(True)
    )


def _banded(value: Column, bands: list[tuple[float, str]], top: str) -> Column:
    out = F.when(value.isNull(), "Unknown").when(value == 0, "Free")
    for limit, label in bands:
        out = out.when(value < limit, label)
    return out.otherwise(top)


def bucket_price(value: Column, free: Column) -> Column:
    """Ticket price band; a free flag wins over the number. Negative prices fall in 0-25."""
    # The bands.
    banded = _banded(value, [(25, "0-25"), (50, "25-50"), (100, "50-100")], "100+")
    return F.when(free, "Free").otherwise(banded)


def bucket_amount(value: Column) -> Column:
    """Payment amount band."""
    # The bands.
    bands = [(25, "0-25"), (50, "25-50"), (100, "50-100"), (250, "100-250")]
    return _banded(value, bands, "250+")


def to_money(c: Column) -> Column:
    """Exact decimal for sums; adding doubles would depend on task order."""
    return safe_float(c).cast(MONEY)


def to_money_text(c: Column) -> Column:
    """Two-decimal text such as ``12.50`` of a decimal column."""
    return F.round(c, 2).cast("decimal(18,2)").cast("string")


def midpoint_price(low: Column, high: Column) -> Column:
    """Mean of a price range, a missing bound counting as 0, halves rounded to even."""
    zero = F.lit(0.0)
    return F.bround((F.coalesce(low, zero) + F.coalesce(high, zero)) / 2, 2)
