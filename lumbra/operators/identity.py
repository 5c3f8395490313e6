"""Legal identity of filed counterparties, and what is odd about it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumbra.functions.identifiers import lei_valid, mod11_valid
from lumbra.functions.text import content_words, name_key, same_name

# Words of vehicles, and the state of an identifier that is in force.
VEHICLES = ("TRUST", "FUND", "PLAN", "BENEFIT", "EMPLOYEE", "COLLATERAL")
IN_FORCE = "ISSUED"


def identified(rows: DataFrame, key: list[str], registry: DataFrame | None = None, group: str | None = None) -> DataFrame:
    """(key, tipo, entidad, nombre, alertas): the legal identity of each row and the codes of what is odd, joined by `;`.

    rows: key columns, rut, verificador, lei, nombre; group: a column whose value should hold one identity. registry: lei,
    estado_lei, nombre_legal, categoria, one row a lei. A tax id goes before a LEI, both before the name; one with a wrong check
    digit is an identity of its own kind. nombre is the registered name of a valid LEI, else the one that the identity's rows have
    most often, ties by the least. Counts by name and group are aggregates, combined before their shuffles; no group's rows are listed."""
    lei = F.nullif(F.upper(F.trim(F.coalesce("lei", F.lit("")))), F.lit(""))
    lei = F.when(lei != "0", lei)
    digit = F.upper(F.trim(F.coalesce("verificador", F.lit(""))))
    r = rows.select(*key, *([F.col(group).alias("_group")] if group else []), F.coalesce(F.col("rut").cast("long"), F.lit(0).cast("long")).alias("_rut"), digit.alias("_digit"), lei.alias("_lei"), F.trim(F.coalesce("nombre", F.lit(""))).alias("_name"))
    good_rut, good_lei = mod11_valid(F.col("_rut"), F.col("_digit")), F.coalesce(lei_valid(F.col("_lei")), F.lit(False))
    kind = F.when(F.col("_rut") > 0, F.when(good_rut, "RUT").otherwise("RUT invalido")).when(F.col("_lei").isNotNull(), F.when(good_lei, "LEI").otherwise("LEI invalido")).otherwise("Sin RUT ni LEI")
    r = r.withColumn("tipo", kind).withColumn("_norm", name_key(F.col("_name")))
    tax = F.concat_ws("-", F.col("_rut"), F.coalesce(F.nullif("_digit", F.lit("")), F.lit("?")))
    own = F.when(F.col("tipo").startswith("RUT"), tax).when(F.col("tipo").startswith("LEI"), F.col("_lei")).otherwise(F.coalesce(F.nullif("_norm", F.lit("")), F.lit("(vacio)")))
    r = r.withColumn("entidad", F.concat_ws(" ", F.when(F.col("tipo") == "Sin RUT ni LEI", "NOMBRE").otherwise(F.col("tipo")), own))
    counts = r.groupBy("entidad", "_name").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("entidad").orderBy(F.desc("n"), "_name"))
    often = counts.withColumn("_k", rank).where("_k = 1").select("entidad", F.col("_name").alias("_often"))
    several = r.where("_lei IS NOT NULL AND _rut = 0").groupBy("_norm").agg(F.count_distinct("_lei").alias("_leis"))
    r = r.join(often, "entidad").join(several, "_norm", "left")
    flags = {
        "lei_invalido": F.col("tipo") == "LEI invalido", "rut_invalido": F.col("tipo") == "RUT invalido", "sin_identificador": F.col("tipo") == "Sin RUT ni LEI",
        "nombre_con_varios_lei": F.col("tipo").startswith("LEI") & (F.col("_leis") > 1),
    }
    name = F.col("_often")
    if registry is not None:
        reg = registry.groupBy(F.col("lei").alias("_lei")).agg(F.max(F.struct("nombre_legal", "estado_lei", "categoria")).alias("_reg"))
        r = r.join(reg, "_lei", "left")
        legal, is_lei = F.col("_reg.nombre_legal"), F.col("tipo") == "LEI"
        name = F.coalesce(F.when(is_lei, legal), name)
        flags |= {
            "lei_no_vigente": is_lei & (F.col("_reg.estado_lei") != IN_FORCE),
            "lei_de_vehiculo": is_lei & ((F.col("_reg.categoria") == "FUND") | F.arrays_overlap(content_words(legal), F.array(*[F.lit(v) for v in VEHICLES]))),
            "lei_de_otro": is_lei & legal.isNotNull() & (F.col("_name") != "") & ~same_name(legal, F.col("_name")),
        }
    if group:
        held = r.where("tipo <> 'Sin RUT ni LEI'").groupBy("_group").agg(F.count_distinct("entidad").alias("_ids"))
        r = r.join(held, "_group", "left")
        flags["grupo_con_varios"] = (F.col("tipo") != "Sin RUT ni LEI") & (F.col("_ids") > 1)
    codes = F.array_join(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in flags.items()])), ";")
    return r.select(*key, "tipo", "entidad", name.alias("nombre"), codes.alias("alertas"))
