"""Bands, prefixes and ordered labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Maturity bands in years, original-tenor bands in days.
MATURITY = ((0.0, "vencido"), (0.25, "0-3m"), (1.0, "3-12m"), (2.0, "1-2a"), (5.0, "2-5a"), (10.0, "5-10a"), (None, "10a+"))
ORIGINAL = ((31, "Hasta 1M"), (92, "1-3M"), (183, "3-6M"), (366, "6-12M"), (731, "1-2A"), (1827, "2-5A"), (3653, "5-10A"), (7305, "10-20A"), (None, "Más de 20A"))


# Families of derivatives by the name of the instrument, in the order in which they are tried.
FAMILIES = (
    ("has", "swap promesa", "Swap UF/CLP"), ("prefix", "CCS", "CCS"), ("prefix", "Forward FX", "Forward FX"), ("is", "Forward UF", "Forward UF"), ("prefix", "IRS", "IRS"),
    ("is", "Opcion", "Opcion"), ("is", "Futuro", "Futuro"), ("is", "Pacto", "Pacto"),
)


def first_match(c: Column, rules: tuple[tuple[str, str, str], ...], other: str) -> Column:
    """Label of the first rule (is, prefix or has; text; label) that fits; other if none does, for a null too. Tables of classes and segments are such rules."""
    fits = {"is": lambda t: c == t, "prefix": c.startswith, "has": c.contains}
    return reduce(lambda a, r: a.when(fits[r[0]](F.lit(r[1])), r[2]), rules, F.when(F.lit(False), F.lit(None).cast("string"))).otherwise(other)


def band(c: Column, edges: tuple, closed: str = "left") -> Column:
    """Label of the first band whose upper edge lies above (closed left) or not below (closed right) the value; null stays null."""
    below = (lambda e: c < e) if closed == "left" else (lambda e: c <= e)
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for edge, label in edges:
        out = out.when(below(F.lit(edge)) if edge is not None else F.lit(True), label)
    return out


def band_order(c: Column, edges: tuple, closed: str = "left") -> Column:
    return F.nullif(F.array_position(F.array(*[F.lit(n) for _, n in edges]), band(c, edges, closed)), F.lit(0)) - 1


def prefix_class(c: Column, classes: dict[str, str], other: str) -> Column:
    """Label of the longest prefix that fits."""
    order = sorted(classes, key=lambda p: (-len(p), p))
    out = reduce(lambda a, p: a.when(c.startswith(p), classes[p]), order, F.when(c.isNull(), F.lit(other)))
    return out.otherwise(other)


def domain_position(c: Column, domain: list[str]) -> Column:
    """Place in a given order; values that aren't in it come last."""
    return F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(x) for x in domain]), c), F.lit(0)), F.lit(len(domain) + 1).cast("long"))
