"""Filling fixed-capacity containers with items.

Items are sizes only; texts never move. An item longer than a container is cut into full containers and a rest.
What is left is spread by hash over as many shards as keep one within a task, each with the same mix of sizes, and
every shard is packed best-fit decreasing: a segment tree over remaining capacities finds the tightest open bin in
logarithmic time. A shard leaves at most a few bins partly filled that a single packing would have filled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbra.session import checkpointed, ship

CAPACITY = 2048
#: Items that one task packs.
SHARD_ITEMS = 200_000


class OpenBins:
    """Open bins by remaining capacity; a segment tree over the capacities tells which are taken."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(self.leaves)]

    def add(self, left: int, bin_: int) -> None:
        self.bins[left].append(bin_)
        i = left + self.leaves
        while i:
            self.tree[i] += 1
            i >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """(remaining, bin) of the open bin with the least remaining capacity of at least need; it is taken out."""
        i = need + self.leaves
        if not self.tree[i]:
            while i > 1 and (i & 1 or not self.tree[i ^ 1]):  # up, until a right sibling holds a bin
                i >>= 1
            if i <= 1:
                return None
            i ^= 1
            while i < self.leaves:  # down to its leftmost bin
                i = 2 * i if self.tree[2 * i] else 2 * i + 1
        left = i - self.leaves
        bin_ = self.bins[left].pop()
        while i:
            self.tree[i] -= 1
            i >>= 1
        return left, bin_


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item (sizes of 1 to capacity); equal sizes keep their order."""
    order = np.argsort(-sizes, kind="stable")
    out = np.empty(len(sizes), dtype=np.int64)
    tree, n = OpenBins(capacity), 0
    for i in order.tolist():
        s = int(sizes[i])
        got = tree.tightest(s)
        left, bin_ = got if got else (capacity, n)
        n += got is None
        out[i] = bin_
        if left > s:
            tree.add(left - s, bin_)
    return out


def packed(items: DataFrame, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """(doc_id, parte, desde, n_tokens, contenedor): where each document, or each cut part of it, goes.

    items: doc_id, n_tokens. Only an item longer than the capacity is cut: parte counts from 0, desde is the part's
    first token. Items without tokens, or with a null size, need no container and are left out; repeated rows count
    once each with their own place. Empty input gives no rows."""
    spark = items.sparkSession
    ship(spark)
    cap = F.lit(capacity).cast("long")
    items = items.select("doc_id", F.col("n_tokens").cast("long").alias("n")).where("n > 0")
    parts = items.withColumn("parte", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / cap))))
    parts = parts.select("doc_id", "parte", (F.col("parte") * cap).alias("desde"), F.least(cap, F.col("n") - F.col("parte") * cap).alias("n_tokens"))
    # written before use, so sizes are computed once, and the number that tells repeated rows apart stays as it is
    parts = checkpointed(parts.withColumn("_row", F.monotonically_increasing_id()))
    n = parts.where(F.col("n_tokens") < cap).count()
    shards = max(1, -(-n // shard_items))
    whole = parts.where(F.col("n_tokens") == cap).select("doc_id", "parte", "desde", "n_tokens", F.concat_ws("-", F.lit("w"), "_row").alias("contenedor"))
    schema = "doc_id long, parte long, desde long, n_tokens long, contenedor string"

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_tokens", "doc_id", "parte"], ascending=[False, True, True], kind="stable")
        bins = best_fit_decreasing(rows["n_tokens"].to_numpy(), capacity)
        return rows[["doc_id", "parte", "desde", "n_tokens"]].assign(contenedor=[f"s{key[0]}-{b}" for b in bins])

    rest = parts.where(F.col("n_tokens") < cap).withColumn("_shard", F.pmod(F.xxhash64("doc_id", "parte", "_row"), F.lit(shards)))
    return rest.groupBy("_shard").applyInPandas(pack, schema).unionByName(whole)


def fill(assigned: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(contenedores, tokens, llenado, minimo): how full the containers are, and the least number that could do."""
    c = assigned.groupBy("contenedor").agg(F.sum("n_tokens").alias("t"))
    return c.agg(
        F.count(F.lit(1)).alias("contenedores"), F.sum("t").alias("tokens"), F.try_divide(F.sum("t").cast("double"), F.count(F.lit(1)) * capacity).alias("llenado"),
        F.ceil(F.sum("t") / capacity).alias("minimo"), F.max("t").alias("mayor"),
    )
