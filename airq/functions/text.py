"""Text helpers: postcodes, keys, lenient integers, figure labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airq.functions.aggregates import col

# Patterns of postcodes, and the characters of a formatted one, its space included.
_EDGE_SPACE = r"^[ \t\r\n]+|[ \t\r\n]+$"
_NOT_IN_CODE = "[^A-Z0-9]"
_NOT_IN_SPACED_CODE = "[^A-Z0-9 ]"
_INWARD_PART = "([A-Z0-9])([0-9][A-Z]{2})$"
_CODE_LENGTHS = (5, 8)


def format_postcode(c: str | Column) -> Column:
    """Upper-case code with one space before the inward part, or NULL.

    The result must have 5 to 8 characters including the space.
    """
    code = F.regexp_replace(F.upper(col(c)), _NOT_IN_CODE, "")
    code = F.regexp_replace(code, _INWARD_PART, "$1 $2")
    return F.when(F.length(code).between(*_CODE_LENGTHS), code)


def clean_postcode(c: str | Column) -> Column:
    """Upper-case code of letters, digits and single spaces."""
    code = F.upper(F.regexp_replace(col(c), _EDGE_SPACE, ""))
    return F.regexp_replace(F.regexp_replace(code, _NOT_IN_SPACED_CODE, ""), r"\s+", " ")


def postcode_area(c: str | Column) -> Column:
    """Leading letter(s): one if the second character is a digit, else two."""
    c = col(c)
    return F.when(F.substring(c, 2, 1).rlike("^[0-9]+$"), F.substring(c, 1, 1)).otherwise(F.substring(c, 1, 2))


def to_int(c: str | Column) -> Column:
    """Whole number in a text, NULL when the text is anything else."""
    return col(c).try_cast("int")


def date_device(date: str | Column = "Date", device: str | Column = "device_id") -> Column:
    """``<date> <device>``, the readable key of a device-day."""
    return F.concat_ws(" ", col(date).cast("string"), col(device).cast("string"))


def number_text(c: str | Column, digits: int) -> Column:
    """Half-even rounded number as text without trailing zeros."""
    rounded = F.bround(col(c), digits)
    fixed = F.format_string(f"%.{digits}f", rounded)
    return fixed if digits == 0 else F.regexp_replace(fixed, r"\.?0+$", "")


def distance_label(n: str | Column, mean: str | Column, median: str | Column, low: str | Column, high: str | Column) -> Column:
    # The words of the label.
    return F.concat(
        F.lit("n = "), col(n).cast("string"),
        F.lit("\nMean = "), number_text(mean, 1),
        F.lit(" km\nMedian = "), number_text(median, 1),
        F.lit(" km\nRange = "), number_text(low, 1), F.lit("–"), number_text(high, 0), F.lit(" km"),
    )


def regression_label(n: str | Column, r: str | Column, r2: str | Column, intercept: str | Column, slope: str | Column) -> Column:
    # The words of the label.
    return F.concat(
        F.lit("n = "), col(n).cast("string"),
        F.lit("\nr = "), number_text(r, 2),
        F.lit("\nR² = "), number_text(r2, 2),
        F.lit("\nIndoor = "), number_text(intercept, 2), F.lit(" + "), number_text(slope, 2), F.lit(" × Outdoor"),
    )
