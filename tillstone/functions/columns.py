"""Column-level helpers.  Everything here is a built-in expression, so it stays inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a text trim removes (ASCII and Latin-1 white space).
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"

# Fixed value: how a company tax id of 14 digits is written.
TAX_ID_LAYOUT = (r"^(\d{2})(\d{3})(\d{3})(\d{4})(\d{2})$", "$1.$2.$3/$4-$5")

MONEY = "decimal(18,2)"
QUANTITY = "decimal(18,4)"


def digits(c: Column) -> Column:
    """Only the digits of a text; NULL stays NULL."""
    return F.regexp_replace(c.cast("string"), r"\D", "")


def unpadded(c: Column) -> Column:
    """Text without leading zeros."""
    return F.ltrim(c.cast("string"), F.lit("0"))


def document_number(c: Column) -> Column:
    """Digits of a document number without leading zeros: '000-12' and '12' are the same document."""
    return unpadded(digits(c))


def stripped(c: Column) -> Column:
    return F.trim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    """SQL trim (spaces only), then '' becomes NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def tax_id_mask(c: Column) -> Column:
    """Company tax id as 00.000.000/0000-00.  Shorter input is zero-padded, longer input is cut to 14."""
    return F.regexp_replace(F.lpad(c, 14, "0"), *TAX_ID_LAYOUT)


def zero(c: Column, decimal_type: str = MONEY) -> Column:
    """NULL read as 0 of the given decimal type."""
    return F.coalesce(c, F.lit(0).cast(decimal_type))


def flag_is(c: Column, value: int) -> Column:
    """A 0/1 flag that may arrive as an integer, a one-character text or a boolean."""
    return c.cast("int") == value


def share(part: Column, whole: Column) -> Column:
    """part / whole as a double, 0 unless the whole is positive."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """part / whole as a double, 0 when the whole is 0."""
    return F.when(whole != 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def month_of(c: Column) -> Column:
    """First day of the month, as a date (date_trunc on a timestamp would give a timestamp)."""
    return F.trunc(c.cast("date"), "MM")
