"""Numeric functions as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbra.functions.text import clean

# Fixed value: words of floating legs.
FLOATING = ("ICP", "LIBOR", "SOFR", "TAB", "VAR", "CAMARA", "TPM", "EURIBOR")


def filed_number(chunk: Column, width: int, decimals: int = 0, signed: bool = False) -> Column:
    """A fixed-width number: commas are zeros, decimals implied, a blank is 0; null if anything else is in it."""
    t = F.translate(chunk, ",", "0")
    body = F.when(F.substring(t, 1, 1).isin("-", "+", " "), F.substring(t, 2, width)).otherwise(t) if signed else t
    digits = F.when(F.trim(t) == "", F.lit("0")).when(body.rlike("^[0-9]+$"), body)
    n = digits.try_cast(f"decimal({min(width, 38)},0)")
    value = (n / F.lit(10**decimals).cast(f"decimal({decimals + 1},0)")).cast(f"decimal({min(width, 38)},{decimals})") if decimals else n.cast("long")
    return F.when(t.startswith("-"), -value).otherwise(value) if signed else value


def tolerant(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "").try_cast("double")


def decimal_only(df: DataFrame, name: str, precision: int = 38, scale: int = 6) -> Column:
    """A column as a decimal if it is a number; text, dates, truth values and NaN are null."""
    kind = df.schema[name].dataType
    c = F.col(name)
    return c.try_cast(f"decimal({precision},{scale})") if isinstance(kind, T.NumericType) else F.lit(None).cast(f"decimal({precision},{scale})")


def first_rate(columns: list[str]) -> Column:
    """struct(valor, etiqueta, origen) of the first column whose text holds a number; null if none does."""
    return F.coalesce(*[F.when(rate_value(F.col(c)).isNotNull(), F.struct(rate_value(F.col(c)).alias("valor"), rate_label(F.col(c)).alias("etiqueta"), F.lit(c).alias("origen"))) for c in columns])


def spanish_amount(c: Column) -> Column:
    """39.643,59 -> 39643.59"""
    t = F.regexp_replace(F.regexp_replace(c, r"[^0-9,.\-]", ""), r"\.", "")
    return F.translate(t, ",", ".").try_cast("decimal(20,4)")


# Fixed value: a number within a rate written as text.
_RATE = r"(-?\d+(?:[.,]\d+)?)"


def rate_value(c: Column) -> Column:
    """Number of a rate written as text: FIJA 5.11 -> 5.11."""
    return F.translate(F.nullif(F.regexp_extract(c, _RATE, 1), F.lit("")), ",", ".").try_cast("double")


def rate_label(c: Column) -> Column:
    """The words of a rate written as text, in capitals; null if it has none: FIJA 5.11 -> FIJA."""
    return F.upper(F.nullif(F.array_join(F.regexp_extract_all(c, F.lit("([A-Za-z_]+)"), F.lit(1)), " "), F.lit("")))


def is_fixed(label: Column) -> Column:
    """True for fixed, false for a known floating word, else null."""
    e = F.upper(F.nullif(label, F.lit("")))
    return F.when(e.contains("FIJA") | e.contains("FIJO"), True).when(e.rlike("|".join(FLOATING)), False)


def first_nonzero(columns: list[str]) -> tuple[Column, Column]:
    """(value, origin): the first value that is neither null nor 0, else the first that isn't null; and its column's name."""
    nonzero = [F.nullif(F.col(c), F.lit(0)) for c in columns]
    value = F.coalesce(*nonzero, *[F.col(c) for c in columns])
    origin = F.coalesce(*[F.when(x.isNotNull(), F.lit(c)) for c, x in zip(columns, nonzero)], *[F.when(F.col(c).isNotNull(), F.lit(c)) for c in columns])
    return value, origin


def relative_difference(new: Column, old: Column) -> Column:
    return F.try_divide(F.abs(new - old), F.abs(F.nullif(old, F.lit(0.0))))


def least_positive(*columns: Column) -> Column:
    return F.least(*[F.when(c > 0, c) for c in columns])


def percent_over(value: Column, market: Column) -> Column:
    return F.when(market > 0, (value / market - 1) * 100)


def breakeven(real: Column, nominal: Column) -> Column:
    """Inflation, in percent, at which a real and a nominal rate pay the same; null if both are 0."""
    return F.when((real != 0) | (nominal != 0), ((1 + nominal / 100) / (1 + real / 100) - 1) * 100)


def compound_difference(one: Column, other: Column) -> Column:
    """What a rate in percent pays over another, compounded, in percent."""
    return (F.try_divide(1 + one / 100, 1 + other / 100) - 1) * 100


def implied_growth(last: Column, first: Column, days: Column) -> Column:
    """Yearly growth in percent that takes the first value to the last in so many days; null if a value isn't positive or no day lies between."""
    ok = (last > 0) & (first > 0) & (days > 0)
    return F.when(ok, (F.pow(last / first, 365.0 / days) - 1) * 100)


def bullet_duration(years: Column, yield_pct: Column, coupon_pct: Column) -> Column:
    """Approximate modified duration of a bond with yearly coupons repaid at once; null out of (0, 100)."""
    n, y, c = years, F.coalesce(F.nullif(yield_pct, F.lit(0.0)), coupon_pct, F.lit(0.0)) / 100, F.coalesce(coupon_pct, F.lit(0.0)) / 100
    zero = (c <= 0) | (F.abs(y) < 1e-9)
    closed = (1 + y) / y - (1 + y + n * (c - y)) / (c * (F.pow(1 + y, n) - 1) + y)
    d = F.when(zero, n / (1 + y)).otherwise(closed / (1 + y))
    return F.when((n > 0) & (y > -0.99), F.when(zero, d).when((d > 0) & (d < 100), d))


def weighted(value: Column, weight: Column, keep: Column | None = None) -> Column:
    """Weighted mean over rows that have both; an aggregate."""
    ok = value.isNotNull() & weight.isNotNull() & (keep if keep is not None else F.lit(True))
    return F.try_divide(F.sum(F.when(ok, value * weight)), F.sum(F.when(ok, weight)))


def exact_sum(c: Column, scale: int = 4) -> Column:
    """Sum in decimals, so that it doesn't depend on the order of the rows; an aggregate.

    Digits beyond the scale are rounded value by value; the default holds every amount of the formats. NaN and values of
    10^24 and more, which no decimal(28,4) holds, are left out as nulls are."""
    return F.sum(c.try_cast(f"decimal({24 + scale},{scale})")).cast("double")
