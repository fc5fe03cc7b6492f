"""Text, number and flag rules of the fixed-width slots."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words a flag may be written with, and their short forms.
TRUE_WORDS = ("t", "tr", "tru", "true", "y", "ye", "yes", "on", "1")
FALSE_WORDS = ("f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0")

# Digits before the point that a number may have.
MOST_EXPONENT = 130_000


def left_pad(text: Column, width: int, fill: str) -> Column:
    return F.lpad(text, width, fill)


def right_pad(text: Column, width: int, fill: str = " ") -> Column:
    return F.rpad(text, width, fill)


def date_text(text: Column, instead_of_dash: str = "") -> Column:
    """ISO date text with its dashes replaced; it is never read as a date."""
    return F.replace(text, F.lit("-"), F.lit(instead_of_dash))


def flag(text: Column) -> Column:
    """TRUE, FALSE, or NULL for a missing or unknown word."""
    word = F.lower(F.trim(text))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def yes_no(condition: Column, yes: str, no: str) -> Column:
    """``yes`` only where the condition is TRUE; FALSE and NULL give ``no``."""
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def required(value: Column, text: Column, what: str) -> Column:
    """``value``, or an error where there is a text but no value could be read from it."""
    unread = text.isNotNull() & value.isNull()
    return F.when(unread, F.raise_error(F.concat(F.lit(f"no {what}: "), text.cast("string")))).otherwise(value)


def whole_number(text: Column) -> Column:
    return text.try_cast("int")


def number_text(text: Column) -> Column:
    """Text of an unscaled number: its digits stay, only the spelling is tidied.

    ``+5`` becomes ``5``, ``007.10`` becomes ``7.10``, ``.5`` becomes ``0.5`` and
    ``1.5e3`` becomes ``1500``.  ``NaN`` is a number.  Text that is no number, or has an
    exponent beyond ``MOST_EXPONENT``, gives NULL.
    """
    plain = r"^(?!-[0.]+$)-?(0|[1-9][0-9]*)(\.[0-9]+)?$"
    loose = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"
    word = F.trim(text)
    body = F.regexp_replace(word, r"^[+-]", "")
    whole = F.regexp_replace(F.regexp_extract(body, r"^0*([0-9]*)", 1), "^$", "0")
    fraction = F.regexp_extract(body, r"(\.[0-9]+)$", 1)
    unsigned = F.concat(whole, fraction)
    negative = word.startswith("-") & unsigned.rlike("[1-9]")
    tidied = F.when(negative, F.concat(F.lit("-"), unsigned)).otherwise(unsigned)
    # An exponent moves the point over the digits as they are written.
    exponent = F.regexp_extract(word, r"[eE]([+-]?[0-9]+)$", 1).try_cast("int")
    before, after = F.regexp_extract(word, r"^[+-]?([0-9]*)", 1), F.regexp_extract(word, r"\.([0-9]*)", 1)
    digits, point = F.concat(before, after), F.length(before) + exponent
    moved = F.concat(F.repeat(F.lit("0"), F.greatest(1 - point, F.lit(0))), digits, F.repeat(F.lit("0"), F.greatest(point - F.length(digits), F.lit(0))))
    at = F.greatest(point, F.lit(1))
    head = F.regexp_replace(F.substring(moved, F.lit(1), at), "^0+(?=[0-9])", "")
    tail = F.substring(moved, at + 1, F.length(moved))
    magnitude = F.when(tail == "", head).otherwise(F.concat(head, F.lit("."), tail))
    minus = word.startswith("-") & digits.rlike("[1-9]")
    shifted = F.when(F.abs(exponent) <= MOST_EXPONENT, F.when(minus, F.concat(F.lit("-"), magnitude)).otherwise(magnitude))
    return (
        F.when(text.rlike(plain), text)
        .when(word.rlike(loose), tidied)
        .when(F.lower(word) == "nan", "NaN")
        .when(word.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)[eE][+-]?[0-9]+$"), shifted)
    )


def starts_like_icd10(code: Column) -> Column:
    return code.rlike("^[A-TV-Z]")


def type_by_letter(code: Column, present: Column | None = None) -> Column:
    """Blank without a code, else ``0`` or ``9`` by the first letter."""
    known = code if present is None else present
    return F.when(known.isNull(), " ").when(starts_like_icd10(code), "0").otherwise("9")


def type_by_length(code: Column) -> Column:
    """Blank without a code, else ``0`` from seven characters on."""
    return F.when(code.isNull(), " ").when(F.length(code) >= 7, "0").otherwise("9")
