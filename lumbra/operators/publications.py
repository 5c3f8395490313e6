"""Which publication of a period is current, and views restricted to it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumbra.session import small


def ranked(facts: list[DataFrame], period: str = "periodo_informacion", archive: str = "zip_origen", seen: str = "fecha_descarga") -> DataFrame:
    """(period, archive, seen, filas, recencia): publications of each period over all facts; 1 is the latest, then the largest, then the greatest name.

    Counting is combined before the shuffle and the window sees one row a publication."""
    counts = None
    for f in facts:
        c = f.groupBy(period, archive).agg(F.max(seen).alias(seen), F.count(F.lit(1)).alias("filas"))
        counts = c if counts is None else counts.unionByName(c)
    total = counts.groupBy(period, archive).agg(F.max(seen).alias(seen), F.sum("filas").alias("filas"))
    order = Window.partitionBy(period).orderBy(F.col(seen).desc_nulls_last(), F.col("filas").desc(), F.col(archive).desc())
    return total.withColumn("recencia", F.row_number().over(order))


def current(fact: DataFrame, publications: DataFrame, period: str = "periodo_informacion", archive: str = "zip_origen") -> DataFrame:
    """Rows of a fact that belong to the current publication of their period."""
    return fact.join(small(publications.where("recencia = 1").select(period, archive)), [period, archive], "left_semi")


def only_once(df: DataFrame, key: list[str]) -> DataFrame:
    """df itself if its key is unique, else a ValueError that names a repeated key; found by one aggregate."""
    twice = df.groupBy(*key).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"repeated key: {twice[0].asDict()}")
    return df


def latest_attribute(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """(key, value): the value of the latest row that has one; ties by the greater value."""
    return rows.where(F.col(value).isNotNull() & F.col(order).isNotNull()).groupBy(key).agg(F.max(F.struct(order, value)).alias("_m")).select(key, F.col(f"_m.{value}").alias(value))
