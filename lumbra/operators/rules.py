"""Three-valued checks of records, verdicts and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check(rule: str, applies: Column, expected: Column, observed: Column, relative: float = 0.0, absolute: float = 0.0) -> Column:
    """struct(rule, ok, expected, observed): ok is null if the rule doesn't apply or a side is missing."""
    e, o = expected.cast("double"), observed.cast("double")
    near = F.abs(o - e) <= F.greatest(F.abs(e) * relative, F.lit(absolute))
    return F.struct(F.lit(rule).alias("rule"), F.when(applies, near).alias("ok"), e.alias("expected"), o.alias("observed"))


def bounded(rule: str, applies: Column, value: Column, limit: Column, fail_above: float, slack: float = 1e-6) -> Column:
    """ok up to the limit, not ok beyond fail_above times the limit, undecided between."""
    v, m = value.cast("double"), limit.cast("double")
    ok = F.when(v <= m * (1 + slack), True).when(v > m * fail_above, False)
    return F.struct(F.lit(rule).alias("rule"), F.when(applies, ok).alias("ok"), m.alias("expected"), v.alias("observed"))


def difference(rule: str, applies: Column, whole: Column, part: Column, rest: Column, absolute: float = 1.0) -> Column:
    """rest is whole less part, a missing part being 0."""
    return check(rule, applies, whole.cast("double") - F.coalesce(part.cast("double"), F.lit(0.0)), rest, absolute=absolute)


def unit_price(rule: str, applies: Column, amount: Column, units: Column, price: Column, scale: float = 1.0, relative: float = 0.005, least: float = 0.0) -> Column:
    """The price that an amount and its units imply is the known price; undecided where there is no amount, or too few units for a rounded amount to tell."""
    told = applies & (amount != 0) & (units > 0) & (units >= least)
    return check(rule, told, price, F.try_divide(amount.cast("double") * scale, units.cast("double")), relative=relative)


def first_fitting(rule: str, candidates: list[Column]) -> Column:
    """The first check that holds, else the first one: one identity under several conventions."""
    out = F.when(F.coalesce(candidates[0]["ok"], F.lit(False)), candidates[0])
    for c in candidates[1:]:
        out = out.when(F.coalesce(c["ok"], F.lit(False)), c)
    return out.otherwise(candidates[0])


def agreement(controls: dict[str, tuple[DataFrame, DataFrame]], tolerance: float = 0.0) -> DataFrame:
    """(control, izquierda, derecha, iguales): totals that should agree, each side a DataFrame of one row and one number from its own source.

    A missing side agrees with nothing."""
    out = None
    for name, (a, b) in controls.items():
        row = a.toDF("izquierda").join(b.toDF("derecha"), F.lit(True)).select(F.lit(name).alias("control"), F.col("izquierda").cast("double"), F.col("derecha").cast("double"))
        out = row if out is None else out.unionByName(row)
    return out.withColumn("iguales", F.coalesce(F.abs(F.col("izquierda") - F.col("derecha")) <= tolerance, F.lit(False)))


def judged(records: DataFrame, checks: list[Column]) -> DataFrame:
    """records with `checks`, `veredicto` (pass, quarantine, unverified) and `motivos`. Nothing is dropped: both are filters of this one."""
    df = records.withColumn("checks", F.array(*checks)) if checks else records.withColumn("checks", F.expr("CAST(array() AS ARRAY<STRUCT<rule: STRING, ok: BOOLEAN, expected: DOUBLE, observed: DOUBLE>>)"))
    fails = F.filter("checks", lambda c: F.coalesce(~c["ok"], F.lit(False)))
    passes = F.filter("checks", lambda c: F.coalesce(c["ok"], F.lit(False)))
    verdict = F.when(F.size(fails) > 0, "quarantine").when(F.size(passes) > 0, "pass").otherwise("unverified")
    return df.withColumn("veredicto", verdict).withColumn("motivos", F.array_join(F.transform(fails, lambda c: c["rule"]), ";"))
