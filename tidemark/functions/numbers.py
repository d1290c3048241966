"""Telephone numbers and subscriber identities, as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_number(number: Column) -> Column:
    """A number in plain international form: digits only, no ``+`` or ``00`` prefix.

    Separators of any kind vanish; short codes stay as they are; a null, or a
    value without digits, gives null.
    """
    digits = F.regexp_replace(number, "[^0-9]", "")
    plain = F.when(F.length(digits) > 8, F.regexp_replace(digits, "^00", "")).otherwise(digits)
    return F.when(plain != "", plain)


def subscriber(imsi: Column) -> Column:
    """The subscriber behind an ``imsi``: its first 15 digits.

    Null for null, for fewer than 15 digits and for the all-zero placeholder.
    """
    digits = F.substring(F.regexp_replace(imsi, "[^0-9]", ""), 1, 15)
    return F.when((F.length(digits) == 15) & (digits != "0" * 15), digits)
