"""Rankings, shares, pivots and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbra.functions.numbers import exact_sum
from lumbra.session import checkpointed


def ordered(df: DataFrame, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """(df with `_id`, offsets): rows range-partitioned and sorted by `order`; `_id` numbers them within their partition, offsets
    (`_part`, `_before`) tell how many rows lie in the partitions before, one row a partition.

    Spark samples the order to balance the partitions, equal values being divided by what follows them, so no task sorts more
    than its part. The result is written, so that numbers and offsets belong together."""
    r = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    parts = r.groupBy(F.shiftright("_id", 33).alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    return r, parts.select("_part", (F.sum("_n").over(Window.partitionBy(F.lit(1)).orderBy("_part")) - F.col("_n")).alias("_before"))


def _placed(r: DataFrame, offsets: DataFrame) -> DataFrame:
    """r with `_rank`, counted from 1, in place of `_id`."""
    at = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return r.withColumn("_part", F.shiftright("_id", 33)).join(F.broadcast(offsets), "_part").withColumn("_rank", at.cast("long")).drop("_part", "_before", "_id")


def global_rank(df: DataFrame, value: str, key: str, descending: bool = False) -> DataFrame:
    """df with `_rank`: exact position by value, ties by key; null values come last, null keys last among equals. Rows equal in both are in any order."""
    first = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    return _placed(*ordered(df, [first, F.asc_nulls_last(key)]))


def quantiles(df: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """(by, one column a share): exact quantiles of the values of each group, interpolated between neighbours; nulls and NaN don't count.

    Groups lie one after another in the order of all rows, so a quantile is a place in it: only the rows at those places are
    picked, and no group's values ever meet in one task."""
    live = df.select(*by, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL AND NOT isnan(_v)")
    r = _placed(*ordered(live, [*[F.asc_nulls_first(b) for b in by], F.asc("_v")]))
    n = r.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min("_rank").alias("_start"))  # combined before its shuffle
    place = {c: F.col("_start") + (F.col("_n") - 1) * F.lit(q) for c, q in shares.items()}
    want = n.select(*by, *[p.alias(c) for c, p in place.items()])
    picks = want.select(*by, F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("at"), x.alias("_rank")) for c in shares for x in (F.floor(c), F.ceil(c))])).alias("x")).select(*by, "x.*").distinct()
    got = r.select("_rank", "_v").join(picks, "_rank")
    weight = F.when(F.col("_rank") == F.floor("at"), 1 - (F.col("at") - F.floor("at"))).otherwise(F.col("at") - F.floor("at"))
    return got.groupBy(*by).agg(*[F.sum(F.when(F.col("c") == c, F.col("_v") * weight)).alias(c) for c in shares])


def positive_rank(df: DataFrame, value: str, key: str, by: list[str] | None = None) -> DataFrame:
    """df with `puesto`: 1 to n among positive values, ties by key; null for the others, which aren't sorted. df is an aggregate with one row a key."""
    live = F.col(value) > 0
    rest = df.where(~F.coalesce(live, F.lit(False))).withColumn("puesto", F.lit(None).cast("int"))
    if not by:
        return global_rank(df.where(live), value, key, descending=True).withColumnRenamed("_rank", "puesto").withColumn("puesto", F.col("puesto").cast("int")).unionByName(rest)
    r, offsets = ordered(df.where(live), [*[F.asc_nulls_first(b) for b in by], F.desc(value), F.asc_nulls_last(key)])
    r = _placed(r, offsets)
    start = r.groupBy(*[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)]).agg((F.min("_rank") - 1).alias("_start"))
    same = [F.col(b).eqNullSafe(F.col(f"_by{i}")) for i, b in enumerate(by)]
    r = r.join(start, same).select(*df.columns, (F.col("_rank") - F.col("_start")).cast("int").alias("puesto"))
    return r.unionByName(rest)


def pinned_top(df: DataFrame, key: str, value: str, n: int, pin: str) -> DataFrame:
    """(key, value, puesto, parte): the first n and the pinned key with its true place, then Resto and Total."""
    whole = df.agg(exact_sum(F.col(value)).alias("_all"))  # one row
    r = positive_rank(df.select(key, value), value, key).join(F.broadcast(whole), F.lit(True)).withColumn("parte", F.try_divide(F.col(value) * 100, F.col("_all"))).drop("_all")
    shown = (F.col("puesto") <= n) | (F.col(key) == pin)
    rest = r.where(~F.coalesce(shown, F.lit(False))).agg(exact_sum(F.col(value)).alias(value)).select(F.lit("Resto").alias(key), value, F.lit(None).cast("int").alias("puesto"), F.lit(None).cast("double").alias("parte"))
    total = r.agg(exact_sum(F.col(value)).alias(value)).select(F.lit("Total").alias(key), value, F.lit(None).cast("int").alias("puesto"), F.lit(100.0).alias("parte"))
    return r.where(shown).select(key, value, "puesto", "parte").union(rest).union(total)


def pivoted(df: DataFrame, rows: list[str], column: str, values: list, amount: Column) -> DataFrame:
    """Wide sums in the order of the given values; a value that never occurs is a column of zeros. One partial aggregate, no second pass."""
    sums = [exact_sum(F.when(F.col(column) == v, amount).otherwise(F.lit(0.0))).alias(str(v)) for v in values]
    return df.groupBy(*rows).agg(*sums, exact_sum(amount).alias("total"))


def tercile(df: DataFrame, value: str, key: str) -> DataFrame:
    """df with `tercil` 1 to 3 by rank of value, ties by key, bounds as of quantiles interpolated between ranks. One row a key."""
    n = df.agg(F.count(F.lit(1)).alias("_n"))  # one row
    r = global_rank(df, value, key).join(F.broadcast(n), F.lit(True))
    cut = lambda k: 1 + (F.col("_n") - 1) * F.lit(k) / 3
    return r.withColumn("tercil", F.when(F.col("_rank") <= cut(1), 1).when(F.col("_rank") <= cut(2), 2).otherwise(3)).drop("_rank", "_n")


def top_value(df: DataFrame, by: list[str], key: str, value: str) -> DataFrame:
    """(by, key, value): the key with the greatest value in each group, ties by the least key."""
    w = Window.partitionBy(*by).orderBy(F.col(value).desc_nulls_last(), F.asc(key))
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
