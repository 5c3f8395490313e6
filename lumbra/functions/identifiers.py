"""Check digits of identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mod11_digit(body: Column) -> Column:
    """Check digit 0-9 or K of a positive number: weights 2 to 7 from the right, again and again."""
    digits = F.split(F.reverse(body.cast("string")), "")
    products = F.transform(digits, lambda d, i: F.coalesce(d.try_cast("int"), F.lit(0)) * (2 + F.pmod(i, F.lit(6))))
    left = 11 - F.pmod(F.aggregate(products, F.lit(0), lambda a, x: a + x), F.lit(11))
    return F.when(body > 0, F.when(left == 11, "0").when(left == 10, "K").otherwise(left.cast("string")))


def mod11_valid(body: Column, digit: Column) -> Column:
    return F.coalesce(mod11_digit(body) == F.upper(F.trim(digit)), F.lit(False))


def mod97_remainder(code: Column) -> Column:
    """Remainder by 97 of a code in which letters count as 10 to 35."""
    chars = F.split(F.upper(code), "")
    step = lambda a, c: F.when(c == "", a).when(c.rlike("[0-9]"), F.pmod(a * 10 + c.try_cast("int"), F.lit(97))).otherwise(F.pmod(a * 100 + F.ascii(c) - 55, F.lit(97)))
    return F.aggregate(chars, F.lit(0), step)


def lei_valid(code: Column) -> Column:
    """Shape of a legal entity identifier and remainder 1."""
    return F.coalesce(code.rlike("^[A-Z0-9]{18}[0-9]{2}$") & (mod97_remainder(code) == 1), F.lit(False))
