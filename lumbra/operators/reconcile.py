"""Reconciliation of two books of trades."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def one_to_one(left: DataFrame, right: DataFrame, on: list[str], left_id: str, right_id: str, left_day: str, right_day: str, days: int) -> DataFrame:
    """(left_id, right_id, dias): mutual nearest trades with equal `on`, at most `days` apart.

    The interval becomes equalities: a left day is looked up in the blocks of `days` + 1 days that it may touch, so the join
    hashes and only days of neighbouring blocks meet. Ties go to the lesser id; greedy order plays no part."""
    # ties go to the lesser id, so of trades with one `on` and day only the least can pair; a trade then meets one a day at most
    least = lambda df, id_, day: df.groupBy(*on, F.to_date(day).alias(day)).agg(F.min(id_).alias(id_))
    left, right = least(left, left_id, left_day), least(right, right_id, right_day)
    block = lambda c: F.floor(F.unix_date(F.to_date(c)) / (days + 1))
    lt = left.select(*on, F.col(left_id).alias("_l"), F.unix_date(F.to_date(left_day)).alias("_ld"), F.explode(F.array(block(left_day) - 1, block(left_day), block(left_day) + 1)).alias("_b"))
    rt = right.select(*on, F.col(right_id).alias("_r"), F.unix_date(F.to_date(right_day)).alias("_rd"), block(right_day).alias("_b"))
    cand = lt.join(rt, [*on, "_b"]).withColumn("dias", F.abs(F.col("_ld") - F.col("_rd"))).where(F.col("dias") <= days).select("_l", "_r", "dias").distinct()
    best = lambda mine, other: F.row_number().over(Window.partitionBy(mine).orderBy("dias", other))
    got = cand.withColumn("_x", best("_l", "_r")).withColumn("_y", best("_r", "_l")).where("_x = 1 AND _y = 1")
    return got.select(F.col("_l").alias(left_id), F.col("_r").alias(right_id), "dias")
