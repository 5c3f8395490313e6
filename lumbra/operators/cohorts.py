"""Cohorts by month of origin, and how they survive."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumbra.functions.numbers import exact_sum
from lumbra.session import small


def survival_matrix(ops: DataFrame, snapshots: DataFrame, cohort: list[str]) -> DataFrame:
    """One row per cohort and snapshot from its origin on; an extinct cohort stays with 0.

    ops: cohort columns with `origen`, `ultima`, `monto`. snapshots: `foto`, one row a period. Operations are summed by
    (cohort, last snapshot) first; what meets the snapshots is that summary, whose size the periods bound."""
    ends = ops.groupBy(*cohort, "ultima").agg(F.count(F.lit(1)).alias("_n"), exact_sum(F.col("monto")).alias("_m"))
    base = ends.groupBy(*cohort).agg(exact_sum(F.col("_m")).alias("originado"))
    shots = small(snapshots.select("foto").distinct())
    grid = base.join(shots, F.col("foto") >= F.col("origen"))
    alive = ends.join(shots, (F.col("foto") >= F.col("origen")) & (F.col("ultima") >= F.col("foto")))
    alive = alive.groupBy(*cohort, "foto").agg(F.sum("_n").alias("vivas"), exact_sum(F.col("_m")).alias("vivo"))
    out = grid.join(alive, [*cohort, "foto"], "left").withColumn("vivas", F.coalesce("vivas", F.lit(0).cast("long"))).withColumn("vivo", F.coalesce("vivo", F.lit(0.0)))
    months = (F.floor(F.col("foto") / 100) - F.floor(F.col("origen") / 100)) * 12 + F.pmod("foto", F.lit(100)) - F.pmod("origen", F.lit(100))
    return out.withColumn("meses", months.cast("int")).withColumn("pct", F.when(F.col("originado") > 0, F.col("vivo") / F.col("originado") * 100))


def chained_survival(matrix: DataFrame) -> DataFrame:
    """(k, curva): product of alive(k) / alive(k-1) over the cohorts observed at both; ends where nothing is left to follow."""
    m = matrix.groupBy("origen", F.col("meses").alias("k")).agg(exact_sum(F.col("vivo")).alias("v"), F.max("originado").alias("o"))
    start = m.where("k = 0").agg(F.try_divide(exact_sum(F.col("v")), exact_sum(F.col("o"))).alias("f")).select(F.lit(0).alias("k"), "f")
    prev = m.select("origen", (F.col("k") + 1).alias("k"), F.col("v").alias("p"))
    step = m.join(prev, ["origen", "k"]).groupBy("k").agg(exact_sum(F.col("v")).alias("v"), exact_sum(F.col("p")).alias("p"))
    order = Window.partitionBy(F.lit(1)).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)  # one row a month
    factors = start.unionByName(step.select("k", F.try_divide("v", F.when(F.col("p") > 0, F.col("p"))).alias("f")))
    return factors.withColumn("_ok", F.min(F.col("f").isNotNull()).over(order)).where("_ok").select("k", (F.product("f").over(order) * 100).alias("curva"))
