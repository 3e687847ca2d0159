"""Coded columns: synonym maps, plausible ranges, bands and flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Spellings of the two sex codes, compared in upper case.
SEX_SYNONYMS = {"M": ("M", "H", "HOMME", "MALE"), "F": ("F", "FEMME", "FEMALE")}
# Label of an unknown age and of the open-ended band.
UNKNOWN_BAND = "inconnu"
BAND_WIDTH = 10
LAST_BAND_START = 100


def normalise_code(value: Column, synonyms: Mapping[str, Sequence[str]], default: str = "") -> Column:
    """Map any accepted spelling to its code; unknown spellings and NULL give ``default``."""
    upper = F.upper(value)
    (first, spellings), *others = synonyms.items()
    mapped = F.when(upper.isin(*spellings), F.lit(first))
    for code, spellings in others:
        mapped = mapped.when(upper.isin(*spellings), F.lit(code))
    return mapped.otherwise(F.lit(default))


def within_or_null(value: Column, low: Column | int, high: Column | int) -> Column:
    return F.when(value.between(low, high), value)


def outside(value: Column, low: Column | float, high: Column | float) -> Column:
    """True when a known value lies out of the inclusive range; NULL is tolerated."""
    return value.isNotNull() & ~value.between(low, high)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)


def age_band(age: Column) -> Column:
    """Ten-year bands; ages below 0 fall in the first, NULL has its own label."""
    start = (F.greatest(F.floor(age / F.lit(BAND_WIDTH)), F.lit(0)) * BAND_WIDTH).cast("int")
    return (
        F.when(age.isNull(), F.lit(UNKNOWN_BAND))
        .when(age >= LAST_BAND_START, F.lit(f"{LAST_BAND_START}+"))
        .otherwise(F.concat(start.cast("string"), F.lit("-"), (start + BAND_WIDTH - 1).cast("string")))
    )


def flag(condition: Column) -> Column:
    """0/1 integer; an unknown condition counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def text_or_blank(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))
