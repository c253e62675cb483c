"""Casts that give NULL for what they cannot read, with ANSI mode on or off.

A ``try_cast`` to an integer that fails costs some twenty times as much as one
that succeeds, because it raises and catches an exception per row.  So text is
matched against a pattern first, and only what is sure to fit is cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The texts accepted as an ISO date, and as an integer or a decimal
# number with <digits> before the point.  Blanks are what Spark's own cast trims.
ISO_DATE_TEXT = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
BLANKS = r"[\x00-\x20\x7f]*"
INTEGER_TEXT = rf"\A{BLANKS}[+-]?<digits>{BLANKS}\z"
DECIMAL_TEXT = rf"\A{BLANKS}[+-]?(<digits>[.][0-9]*|[.][0-9]+){BLANKS}\z"
_POINT_ON = rf"\A({BLANKS}[+-]?)([0-9]*)[.][0-9]*{BLANKS}\z"

#: Digits that a bigint holds whatever they are, after any leading zeros.
_SAFE_DIGITS = "0*[0-9]{1,18}"
_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32}


def whole_number(text: Column, to: T.IntegralType | None = None) -> Column:
    """Text to an integer: ``'8'`` is 8, ``'1.5'`` is 1, ``'1e3'`` and ``'x'`` are NULL.

    Digits after the point are cut off, not rounded, and never pass through a
    double.  Numbers that do not fit ``to`` (int by default) are NULL.
    """
    to = to or T.IntegerType()
    bits = _BITS.get(type(to))
    digits = _SAFE_DIGITS if bits else "[0-9]+"
    # The point and what follows go; a zero in front makes '.5' a number too.
    units = F.regexp_replace(text, _POINT_ON, "$10$2")
    number = F.when(
        text.rlike(INTEGER_TEXT.replace("<digits>", digits)), text.try_cast("bigint")
    ).when(text.rlike(DECIMAL_TEXT.replace("<digits>", digits)), units.try_cast("bigint"))
    if not bits:
        return number
    limit = 1 << (bits - 1)
    return F.when(number.between(-limit, limit - 1), number.cast(to))


def iso_date(text: Column) -> Column:
    """``yyyy-MM-dd`` text to DATE, anything else NULL.

    A date has exactly one such text.  The pattern plus the cast costs about
    two thirds of a formatter-based parse, and a tenth of it on bad rows.
    """
    return F.when(text.rlike(ISO_DATE_TEXT), text.try_cast("date"))


def tolerant_cast(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """``column`` as ``want``; unreadable values and overflow become NULL."""
    if have == want:
        return column
    if isinstance(have, T.StringType) and isinstance(want, T.IntegralType):
        return whole_number(column, want)
    return column.try_cast(want)
