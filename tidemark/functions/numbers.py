"""Number columns: rounding, tolerant casts, safe ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def half_even(value: Column, digits: int = 0) -> Column:
    """Round a float to ``digits`` places, ties to the even neighbour.

    The scaled binary value decides the tie, so 0.125 becomes 0.12 while ``round``
    gives 0.13.
    """
    if digits == 0:
        return F.rint(value)
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL, not an error, when the denominator is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, total: Column, digits: int) -> Column:
    return half_even(ratio(part * F.lit(100), total), digits)


def int_from_text(text: Column, type_name: str = "int") -> Column:
    """Whole numbers in text; anything else, blanks and overflow included, is NULL."""
    return F.when(text.rlike(r"^[+-]?\d+$"), text).try_cast(type_name)


def int_from_number(value: Column, type_name: str = "int") -> Column:
    """Whole numbers in a numeric column; fractions, NaN and overflow are NULL.

    Never goes through text: the text form of 72.0 is not a whole number.
    """
    return F.when(value == F.floor(value), value).try_cast(type_name)


def float_from_number(value: Column) -> Column:
    return value.try_cast("float")


def number_text(value: Column) -> Column:
    """Text of a number with no trailing ``.0``."""
    return F.regexp_replace(value.cast("string"), r"\.0$", "")
