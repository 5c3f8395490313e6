"""Mixing sources to target weights.

Each source's distinct texts fall into blocks by hash. From the blocks' sizes a plan is drawn: how often each source
is passed through, in which permuted order its blocks come, and where the last pass stops. A multivariate-
hypergeometric splitting tree divides the exact block quotas of all sources among groups of output shards, halving them
at each node; a group then draws its next disjoint blocks of each permuted order. Where a group has several shards, its
texts fall into finer blocks, whose numbers the tree's lower part divides among the group's shards, group by group and in
the tasks. A shard shuffles its texts locally. The driver sees a fixed number of blocks a source and of groups, whatever
the data's size; texts never move.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumbra.session import checkpointed, counted_small, ship

#: Blocks of a source, and groups of shards at most: what the driver plans. More make the plan finer, not the result.
BLOCKS, GROUPS = 1024, 1024
#: Tokens of an output shard, and finer blocks a shard and source.
SHARD_TOKENS, FINER = 4_000_000, 8
#: Texts that are added up in one task where a source's last block is cut.
CUT_ROWS = 100_000
#: Sources that a plan may have.
MAX_SOURCES = 1000
SEED = 20240611


def split_quotas(counts: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """Blocks of each source (columns) in each shard (rows): rows differ in total by one at most, columns add up to counts."""
    out = np.zeros((shards, len(counts)), dtype=np.int64)

    def node(lo: int, hi: int, have: np.ndarray, path: int) -> None:
        if hi - lo == 1:
            out[lo] = have
            return
        mid = (lo + hi) // 2
        total = int(have.sum())
        take = total * (mid - lo) // (hi - lo)
        rng = np.random.default_rng([seed, path])
        left = rng.multivariate_hypergeometric(have, take, method="marginals") if total else have * 0
        node(lo, mid, left, 2 * path)
        node(mid, hi, have - left, 2 * path + 1)

    node(0, shards, np.asarray(counts, dtype=np.int64), 1)
    return out


def draw_plan(blocks: dict[str, np.ndarray], weights: dict[str, float], repeats: dict[str, int], shard_tokens: int = SHARD_TOKENS, seed: int = SEED) -> list[tuple]:
    """(source, block, repeticion, group, tokens): draws of blocks; tokens is null for a whole block, else how much of it is taken.

    blocks: tokens of each block of each source. The total is the greatest that lets every source have its share."""
    live = [s for s in sorted(weights) if weights[s] > 0 and repeats.get(s, 0) > 0 and s in blocks and blocks[s].sum() > 0]
    if not live:
        return []
    share = {s: weights[s] / sum(weights[x] for x in live) for s in live}
    total = min(repeats[s] * float(blocks[s].sum()) / share[s] for s in live)
    draws: dict[str, list[tuple]] = {}
    for k, s in enumerate(live):
        quota, own, r = int(round(total * share[s])), [], 0
        quota = min(quota, repeats[s] * int(blocks[s].sum()))
        while quota > 0:
            order = np.random.default_rng([seed, k, r]).permutation(len(blocks[s]))
            order = order[blocks[s][order] > 0]
            until = np.cumsum(blocks[s][order])
            n = int(np.searchsorted(until, quota, side="right"))
            own += [(s, int(b), r, None) for b in order[:n]]
            quota -= int(until[n - 1]) if n else 0
            if n < len(order):
                own += [(s, int(order[n]), r, quota)] if quota > 0 else []
                break
            r += 1
        draws[s] = own
    groups = int(min(GROUPS, max(1, total // shard_tokens)))
    quotas = split_quotas(np.array([len(draws[s]) for s in live]), groups, seed)
    plan = []
    for k, s in enumerate(live):
        ends = np.cumsum(quotas[:, k])
        # permuted across passes too, so that repeats of a block don't follow one another
        order = np.random.default_rng([seed, k, 1 << 20]).permutation(len(draws[s]))
        where = np.searchsorted(ends, np.arange(len(order)), side="right")
        plan += [(*draws[s][d][:3], int(w), draws[s][d][3]) for d, w in zip(order, where)]
    return plan


def units(documents: DataFrame, sources: DataFrame) -> DataFrame:
    """(doc_id, source, n_tokens, block) of the distinct texts of the sources that have tokens. sources: source, one row each.

    A text sent again, in whatever source, is one text: the least doc_id stands for it, as repeats of a text are capped."""
    key = F.sha2(F.coalesce("text", F.lit("")), 256).alias("_text")
    one = documents.where("n_tokens > 0").select(key, F.struct("doc_id", "source", "n_tokens").alias("d")).groupBy("_text").agg(F.min("d").alias("d")).select("d.*")
    one = one.join(F.broadcast(sources), "source", "left_semi")  # MAX_SOURCES rows
    return one.select("doc_id", "source", "n_tokens", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(BLOCKS)).cast("int").alias("block"))


def _up_to_quota(part: DataFrame) -> DataFrame:
    """Of each block drawn in part (`_quota`), the texts in order of hash whose running total stays within the quota.

    The running total is that of the hash ranges before, a few rows each, and that within a text's own range, so no task adds
    up more than about CUT_ROWS texts however large the block."""
    ranges = max(1, -(-part.count() // CUT_ROWS))
    draw = ["source", "block", "repeticion"]
    rank = F.xxhash64("doc_id", "repeticion", F.lit(SEED))
    part = part.withColumn("_h", rank).withColumn("_range", F.floor((F.col("_h") / 2.0**64 + 0.5) * ranges))
    sums = part.groupBy(*draw, "_range").agg(F.sum("n_tokens").alias("_t"))
    before = sums.withColumn("_before", F.sum("_t").over(Window.partitionBy(*draw).orderBy("_range")) - F.col("_t")).drop("_t")
    own = F.sum("n_tokens").over(Window.partitionBy(*draw, "_range").orderBy("_h", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    got = part.withColumn("_c", own).join(before, [*draw, "_range"])
    return got.where(F.col("_c") + F.col("_before") <= F.col("_quota")).drop("_h", "_range", "_c", "_before")


def _shards_of_groups(got: DataFrame, shard_tokens: int) -> DataFrame:
    """got with `shard`: a group of several shards divides its finer blocks among them by the splitting tree, group by group in the tasks."""
    spark = got.sparkSession
    ship(spark)
    sizes = got.groupBy("_group").agg(F.greatest(F.lit(1), F.floor(F.sum("n_tokens") / shard_tokens)).cast("int").alias("_shards"))
    fine = got.join(counted_small(sizes), "_group").withColumn("_fine", F.pmod(F.xxhash64("doc_id", "repeticion", F.lit(SEED + 1)), F.col("_shards") * FINER).cast("int"))
    blocks = fine.select("_group", "_shards", "source", "_fine").where("_shards > 1").distinct()

    def divide(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["source", "_fine"], ignore_index=True)
        names, counts = np.unique(rows["source"].to_numpy(dtype=str), return_counts=True)
        quotas = split_quotas(counts, int(rows["_shards"].iloc[0]), SEED + 1 + int(key[0]))
        at = np.zeros(len(rows), dtype=np.int64)
        for k, name in enumerate(names):
            own = np.flatnonzero(rows["source"].to_numpy(dtype=str) == name)
            order = np.random.default_rng([SEED, int(key[0]), k]).permutation(len(own))
            at[own[order]] = np.searchsorted(np.cumsum(quotas[:, k]), np.arange(len(own)), side="right")
        return rows[["_group", "source", "_fine"]].assign(_within=at)

    within = blocks.groupBy("_group").applyInPandas(divide, "_group int, source string, _fine int, _within long")
    out = fine.join(within, ["_group", "source", "_fine"], "left")
    return out.withColumn("shard", F.concat_ws("-", "_group", F.coalesce("_within", F.lit(0)))).drop("_group", "_shards", "_fine", "_within")


def mixed(documents: DataFrame, targets: DataFrame, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(shard, orden, doc_id, source, repeticion, n_tokens): the mixture, in reading order of each shard.

    documents: doc_id, text, source, n_tokens. targets: source, peso, max_repeticiones; of repeated sources the greatest
    row counts. Sources that are absent, have no weight, or may not be used are left out and the other weights
    scaled up; texts of other sources and null sources are left out. No text is used more than max_repeticiones
    times. Of the last block only as many texts are taken as fit its quota. A shard, named group-place, has about
    shard_tokens, however many there are. More than MAX_SOURCES sources are an error. Empty input gives no rows."""
    spark = documents.sparkSession
    one = targets.groupBy("source").agg(F.max(F.struct("peso", "max_repeticiones")).alias("g")).select("source", "g.*").where("source IS NOT NULL")
    goal = one.limit(MAX_SOURCES + 1).collect()
    if len(goal) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    pool = checkpointed(units(documents, spark.createDataFrame([(r["source"],) for r in goal], "source string")))
    sizes = pool.groupBy("source", "block").agg(F.sum("n_tokens").alias("t")).collect()  # BLOCKS rows a source at most
    blocks: dict[str, np.ndarray] = {}
    for r in sizes:
        blocks.setdefault(r["source"], np.zeros(BLOCKS, dtype=np.int64))[r["block"]] = r["t"]
    plan = draw_plan(blocks, {r["source"]: r["peso"] or 0.0 for r in goal}, {r["source"]: r["max_repeticiones"] or 0 for r in goal}, shard_tokens)
    plan_df = spark.createDataFrame(plan, "source string, block int, repeticion int, _group int, _quota long")
    got = pool.join(counted_small(plan_df), ["source", "block"])
    whole = got.where("_quota IS NULL").drop("_quota")
    part = _up_to_quota(got.where("_quota IS NOT NULL")).drop("_quota")
    out = _shards_of_groups(whole.unionByName(part), shard_tokens)
    rank = F.xxhash64("doc_id", "repeticion", F.lit(SEED))
    order = F.row_number().over(Window.partitionBy("shard").orderBy(rank, "doc_id"))
    return out.withColumn("orden", order).select("shard", "orden", "doc_id", "source", "repeticion", "n_tokens")


def shares(mixture: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, peso, tokens, parte, usos): the share of the tokens that each source really has, and the most uses of a text."""
    used = mixture.groupBy("source", "doc_id").agg(F.count(F.lit(1)).alias("u"), F.sum("n_tokens").alias("t"))
    own = used.groupBy("source").agg(F.sum("t").alias("tokens"), F.max("u").alias("usos"))
    total = F.sum("tokens").over(Window.partitionBy(F.lit(1)))  # a row a source
    goal = targets.groupBy("source").agg(F.max("peso").alias("peso"))
    got = goal.join(own, "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0).cast("long")))
    return got.withColumn("parte", F.try_divide(F.col("tokens").cast("double"), total)).select("source", "peso", "tokens", "parte", F.coalesce("usos", F.lit(0).cast("long")).alias("usos"))
