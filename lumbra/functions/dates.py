"""Date and period functions as Catalyst expressions. A period is an integer AAAAMM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def period_end(p: Column) -> Column:
    return F.last_day(F.try_to_date(F.concat(p.cast("string"), F.lit("01")), "yyyyMMdd"))


def months_back(p: Column, k: int = 1) -> Column:
    t = F.floor(p / 100) * 12 + F.pmod(p, F.lit(100)) - 1 - k
    return (F.floor(t / 12) * 100 + F.pmod(t, F.lit(12)) + 1).cast("int")


def period_of(d: Column) -> Column:
    return (F.year(d) * 100 + F.month(d)).cast("int")


def months_apart(a: Column, b: Column) -> Column:
    """Calendar months from date a to date b."""
    return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)


def filed_date(c: Column) -> Column:
    """AAAAMMDD; zeros, blanks and impossible dates are null."""
    return F.try_to_date(F.when(c.rlike("^[0-9]{8}$") & (c != "00000000"), c), "yyyyMMdd")


def period_token(token: Column) -> Column:
    """Six digits as AAAAMM if that is a month, else as AAMMDD of a closing date; else null."""
    y, m = F.substring(token, 1, 4).try_cast("int"), F.substring(token, 5, 2).try_cast("int")
    direct = y.between(2000, 2100) & m.between(1, 12)
    m2, d2 = F.substring(token, 3, 2).try_cast("int"), F.substring(token, 5, 2).try_cast("int")
    closing = m2.between(1, 12) & d2.between(1, 31)
    return F.when(token.rlike("^[0-9]{6}$"), F.when(direct, y * 100 + m).when(closing, (F.substring(token, 1, 2).try_cast("int") + 2000) * 100 + m2))


def century_fixed(expiry: Column, trade: Column) -> Column:
    return F.when(expiry < trade, F.add_months(expiry, 1200)).otherwise(expiry)


def bucket(d: Column, unit: str) -> Column:
    return F.trunc(d, unit)


def tenor_years(a: Column, b: Column) -> Column:
    return F.datediff(b, a) / 365.25
