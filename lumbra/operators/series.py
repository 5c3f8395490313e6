"""As-of values of a series, and closes of months."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumbra.session import small


def value_as_of(events: DataFrame, series: DataFrame, at: str, date: str = "fecha", value: str = "valor") -> DataFrame:
    """events with `value`: the last one of the series not after the event, however long ago; null before the first and for a null event.

    The series becomes intervals between its dates, and an event finds its interval by an equality on the months that the
    interval touches, so nothing is joined by range alone. What follows the last date is one row. A series has one value a
    date; of repeats the greatest counts."""
    s = series.where(F.col(date).isNotNull()).groupBy(F.to_date(date).alias("_from")).agg(F.max(value).alias(value))
    s = s.withColumn("_to", F.lead("_from").over(Window.partitionBy(F.lit(1)).orderBy("_from")))  # one row a date
    last = s.where("_to IS NULL").agg(F.max("_from").alias("_last"), F.max(value).alias("_after"))  # one row
    spans = F.sequence(F.trunc("_from", "month"), F.trunc("_to", "month"), F.expr("INTERVAL 1 MONTH"))
    s = s.where("_to IS NOT NULL").withColumn("_month", F.explode(spans))
    day = F.to_date(at)
    e = events.withColumn("_day", day).withColumn("_m", F.trunc(day, "month"))
    hit = e.join(small(s), (F.col("_m") == F.col("_month")) & (F.col("_day") >= F.col("_from")) & (F.col("_day") < F.col("_to")), "left")
    hit = hit.join(F.broadcast(last), F.lit(True)).withColumn(value, F.when(F.col("_day") >= F.col("_last"), F.col("_after")).otherwise(F.col(value)))
    return hit.drop("_day", "_m", "_month", "_from", "_to", "_last", "_after")


def month_close(series: DataFrame, date: str = "fecha", value: str = "valor") -> DataFrame:
    """(periodo, fecha, valor): the last published value within each month; a month without values has no row."""
    rows = series.where(F.col(value).isNotNull())
    last = rows.groupBy((F.year(date) * 100 + F.month(date)).cast("int").alias("periodo")).agg(F.max(F.struct(F.to_date(date).alias("fecha"), F.col(value).alias("valor"))).alias("_m"))
    return last.select("periodo", "_m.fecha", "_m.valor")
