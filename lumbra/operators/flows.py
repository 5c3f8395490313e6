"""Positions and their flows between two periods."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbra.functions.dates import period_end
from lumbra.functions.numbers import exact_sum, relative_difference
from lumbra.session import small

TOLERANCE = 0.10
ATTRIBUTES = ["producto", "contraparte_key", "contraparte_grupo", "contraparte_nombre", "moneda"]


def positions(lines: DataFrame, keys: list[str], attributes: list[str]) -> DataFrame:
    """One row per position: sums of notional and net value, latest maturity, least attribute, number of items. Blank folios are left out."""
    return (
        lines.where(F.col("folio_operacion").isNotNull() & (F.col("folio_operacion") != "")).groupBy(*keys, "folio_operacion")
        .agg(*[F.min(c).alias(c) for c in attributes], F.max("fecha_vencimiento").alias("fecha_vencimiento"),
             exact_sum(F.coalesce("nocional_m", F.lit(0.0)), 4).alias("nocional_m"),
             exact_sum(F.coalesce("mtm_activo_m", F.lit(0.0)) - F.coalesce("mtm_pasivo_m", F.lit(0.0)), 4).alias("mtm_neto_m"), F.count(F.lit(1)).alias("items"))
    )


def mutual_nearest(left: DataFrame, right: DataFrame, group: list[str], key: str, value: str, tolerance: float) -> DataFrame:
    """(group, _l, _r, _ln, _rn): keys and values of left and right rows that are each other's nearest in value within the band |r - l| <= tolerance |l|.

    Ties go to the lesser key, so of rows with one value only the least key can pair. In order of value, what lies nearest
    stands next to a row on either side, and if that is out of the band so is all beyond it: a window finds both neighbours
    and no pairs are listed. Values fall into magnitude ranges in which everything within the band is in a row's own range
    or the next ones, so even a group of very many rows is divided. tolerance is less than 1; zero and null values don't pair."""
    base = math.log(1.001 / (1 - tolerance))
    reps = lambda df, side: df.where(F.col(value) != 0).groupBy(*group, value).agg(F.min(key).alias("_k")).withColumn("_s", F.lit(side))
    u = reps(left, 0).unionByName(reps(right, 1)).withColumn("_own", F.floor(F.log(F.abs(value)) / base))
    u = u.withColumn("_b", F.explode(F.array(F.col("_own") - 1, F.col("_own"), F.col("_own") + 1))).withColumn("_sign", F.signum(value))
    w = Window.partitionBy(*group, "_sign", "_b").orderBy(value, "_s")
    other = lambda side: F.when(F.col("_s") == side, F.struct(F.col(value).alias("v"), F.col("_k").alias("k")))
    before = lambda side: F.last(other(side), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = lambda side: F.first(other(side), ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    is_left = F.col("_s") == 0
    u = u.withColumn("_p", F.when(is_left, before(1)).otherwise(before(0))).withColumn("_n", F.when(is_left, after(1)).otherwise(after(0))).where("_b = _own")

    def candidate(c: str) -> Column:
        d = F.abs(F.col(value) - F.col(f"{c}.v"))
        return F.when(d <= tolerance * F.abs(F.when(is_left, F.col(value)).otherwise(F.col(f"{c}.v"))), F.struct(d.alias("d"), F.col(f"{c}.k").alias("k"), F.col(f"{c}.v").alias("v")))

    u = u.withColumn("_best", F.least(candidate("_p"), candidate("_n"))).where("_best IS NOT NULL")
    side = lambda i, mine, its, n: u.where(F.col("_s") == i).select(*group, F.col("_k").alias(mine), F.col("_best.k").alias(its), F.col(value).alias(n))
    return side(0, "_l", "_r", "_ln").join(side(1, "_r", "_l", "_rn"), [*group, "_l", "_r"])


def month_pairs(snapshots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(now, before) of every month whose calendar month before is there too: rows of both, `periodo` being the later month.

    The months are few; they are compared as a table and never listed."""
    months = snapshots.select("periodo").distinct()
    after = F.when(F.col("periodo") % 100 == 12, F.col("periodo") + 89).otherwise(F.col("periodo") + 1).cast("int")
    both = small(months.join(months.select(after.alias("periodo")), "periodo"))
    return snapshots.join(both, "periodo", "left_semi"), snapshots.withColumn("periodo", after).join(both, "periodo", "left_semi")


def classify(now: DataFrame, before: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Flows of each month (`periodo` of both sides): ACTIVE in both, NEW, UNWIND, MATURITY, and ROLL for a vanished and a new position that replace each other.

    A roll needs the same company, counterparty and product, notionals within the tolerance, and that each be the other's
    nearest. It goes before the other categories. A vanished position without a maturity, or with one after the month's
    end, counts as unwound. One row a position and month on each side; empty sides give what the other side has."""
    key = ["periodo", "rut_compania", "folio_operacion"]
    own = [*ATTRIBUTES, "fecha_vencimiento", "nocional_m", "mtm_neto_m"]
    pack = lambda df, name: df.select(*key, F.struct(*own).alias(name))
    both = pack(now, "n").join(pack(before, "o"), key, "full")
    lone = lambda side, other: both.where(F.col(other).isNull()).select(*key, f"{side}.contraparte_key", f"{side}.producto", f"{side}.nocional_m")
    rolls = mutual_nearest(lone("o", "n"), lone("n", "o"), ["periodo", "rut_compania", "contraparte_key", "producto"], "folio_operacion", "nocional_m", tolerance)
    rolls = rolls.select("periodo", "rut_compania", "_l", "_r", relative_difference(F.col("_rn"), F.col("_ln")).alias("dif_rel_nocional"))
    ends = F.explode(F.array(F.struct(F.col("_l").alias("f"), F.col("_r").alias("p"), F.lit("o").alias("s")), F.struct(F.col("_r").alias("f"), F.col("_l").alias("p"), F.lit("n").alias("s"))))
    paired = rolls.select("periodo", "rut_compania", "dif_rel_nocional", ends.alias("e")).select("periodo", "rut_compania", "dif_rel_nocional", F.col("e.f").alias("folio_operacion"), F.col("e.p").alias("folio_par"), F.col("e.s").alias("_side"))
    side = F.when(F.col("o").isNull(), "n").when(F.col("n").isNull(), "o").otherwise("")
    got = both.withColumn("_side", side).join(paired, [*key, "_side"], "left")
    here = F.coalesce("n", "o")
    late = here["fecha_vencimiento"].isNull() | (here["fecha_vencimiento"] > period_end(F.col("periodo")))
    kind = F.when(F.col("_side") == "", "ACTIVE").when(F.col("folio_par").isNotNull(), "ROLL").when(F.col("_side") == "n", "NEW").when(late, "UNWIND").otherwise("MATURITY")
    return got.select(
        "periodo", kind.alias("categoria"), "rut_compania", "folio_operacion", *[here[c].alias(c) for c in (*ATTRIBUTES, "fecha_vencimiento")],
        F.col("n.nocional_m").alias("nocional_m"), F.col("o.nocional_m").alias("nocional_prev_m"), here["mtm_neto_m"].alias("mtm_neto_m"), "folio_par", "dif_rel_nocional",
    )


def cascade(flows: DataFrame) -> DataFrame:
    """Of each month: opening, new, rolled in and out, matured, unwound, change of what stayed, closing; closing is the sum of the others."""
    amount = lambda cat, c: exact_sum(F.when(F.col("categoria") == cat, F.coalesce(c, F.lit(0.0))).otherwise(F.lit(0.0)), 4)
    n, p = F.col("nocional_m"), F.col("nocional_prev_m")
    return flows.groupBy("periodo").agg(
        exact_sum(F.coalesce(p, F.lit(0.0)), 4).alias("apertura"), amount("NEW", n).alias("nuevas"), amount("ROLL", n).alias("roll_entra"), amount("ROLL", p).alias("roll_sale"),
        amount("MATURITY", p).alias("vencidas"), amount("UNWIND", p).alias("deshechas"), amount("ACTIVE", n - p).alias("cambio_activas"), exact_sum(F.coalesce(n, F.lit(0.0)), 4).alias("cierre"),
    )


def relative_change(flows: DataFrame) -> DataFrame:
    return flows.withColumn("cambio_rel", relative_difference(F.col("nocional_m"), F.col("nocional_prev_m")))
