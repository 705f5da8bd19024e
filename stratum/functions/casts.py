"""Casts that turn bad input into NULL whatever the session's ANSI setting is."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A whole number, perhaps with a fraction to be cut off, between blanks.
_WHOLE_NUMBER = r"^[\p{Cntrl}\s]*([+-]?[0-9]*)(\.[0-9]*)?[\p{Cntrl}\s]*$"
_FRACTION = r"^[\p{Cntrl}\s]*[+-]?\.[0-9]*[\p{Cntrl}\s]*$"


def to_day(value: Column) -> Column:
    """Calendar day of a text, timestamp or date; NULL when it is none."""
    return value.try_cast("date")


def to_double(value: Column) -> Column:
    return value.try_cast("double")


def to_int(value: Column, from_text: bool = True) -> Column:
    """Whole number, truncating toward zero.

    Text goes through a pattern first: ``try_cast('3.7' as int)`` is NULL, and a cast that fails costs many times one
    that does not, so only whole numbers reach it. A bare fraction is 0, as it is to a cast without ANSI.
    """
    if not from_text:
        return value.try_cast("int")
    whole = F.regexp_extract(value, _WHOLE_NUMBER, 1)
    bare = F.when(value.rlike(_FRACTION), F.lit(0))
    other = F.when(whole.isin("", "+", "-"), bare).otherwise(whole.try_cast("int"))
    # Digits alone, perhaps with a point after the first of them, need no pattern.
    digits = F.substring_index(value, ".", 1)
    plain = F.translate(value, "0123456789", "").isin("", ".") & (digits != "")
    return F.when(plain, digits.try_cast("int")).otherwise(other)
