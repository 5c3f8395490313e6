"""Resolution of counterparties against a catalog, by identifier, alias and similarity."""

from __future__ import annotations

import math
from difflib import SequenceMatcher
from functools import reduce
from itertools import accumulate
from operator import add

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbra.functions.text import name_key
from lumbra.session import counted_small, ship, small

#: Least similarity, least lead over the second, least share of common words.
LEAST, LEAD, LEAST_OVERLAP = 0.92, 0.03, 0.3
#: Similarity below which a candidate can neither win nor hold up the winner.
NEXT = LEAST - LEAD
#: Least twice the letters in common, as a share of both names' letters; bounds on lengths, letters and edits follow from it.
REACH = NEXT - 1e-9
#: Largest size in bytes of the index of aliases that is broadcast.
INDEX_LIMIT = 160 << 20

# Bits for how often a name has each letter, and one of BITS for each pair of letters that follow each other.
ROOM = dict(zip("AEIOURNSLDCTMPBGVFHZQXKJYW 0123456789", (7, 7, 6, 7, 4, 6, 5, 5, 5, 4, 4, 4, 4, 3, 3, 3, 3, 3, 3, 2, 2, 2, 2, 2, 2, 2, 5, *[1] * 10)))
FROM = dict(zip(ROOM, accumulate(ROOM.values(), initial=0)))
LONG, BITS = 63, 4 * 63
PAIR = {x + y: 1 << (i * len(ROOM) + j) % BITS for i, x in enumerate(ROOM) for j, y in enumerate(ROOM)}
SIGNS = ("_l0", "_l1", "_more", "_p0", "_p1", "_p2", "_p3")


def common_letters(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    every = free = (1 << len(a)) - 1
    for y in b:
        hit = free & at.get(y, 0)
        free = (free + hit | free - hit) & every
    return len(a) - free.bit_count()


def similarity(a: str, b: str) -> float:
    """The matcher's ratio; 0 where the letters in common leave it below NEXT."""
    return SequenceMatcher(None, a, b).ratio() if 2 * common_letters(a, b) >= REACH * (len(a) + len(b)) else 0.0


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity(x, y) for x, y in zip(a, b)], dtype="float64")


def signs_of(name: str) -> tuple[int, ...]:
    """SIGNS of a name: its letters as bits, how many found no bit, its pairs of letters as bits."""
    letters = pairs = 0
    for x in set(name) & ROOM.keys():
        letters |= (1 << min(name.count(x), ROOM[x])) - 1 << FROM[x]
    for x, y in zip(name, name[1:]):
        pairs |= PAIR.get(x + y, 0)
    part = lambda v, i: v >> LONG * i & (1 << LONG) - 1
    return part(letters, 0), part(letters, 1), len(name) - letters.bit_count(), *(part(pairs, i) for i in range(4))


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in SIGNS]))
def signs(names: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([signs_of(x) for x in names], columns=SIGNS, dtype="int64")


def word_list(c: str) -> Column:
    return F.array_distinct(F.split(c, " "))


def similar(names: DataFrame, known: DataFrame) -> DataFrame:
    """_name, alias, _s: all pairs with enough common words that are similar by NEXT or more.

    names: `_name`, distinct. known: `alias`, distinct. Both sides' words are ordered by how many aliases have them, rarest first.
    Two names of n and m words that share t of them meet in the first n - t + 1 and m - t + 1, so the common words are left out
    wherever the share asks for more than they can give. Pairs that meet are held against what NEXT leaves possible: lengths,
    letters in common, then pairs of letters (a missing letter breaks two, a letter put in one), edits, and last the matcher."""
    often = known.select(F.explode(word_list("alias")).alias("_w")).groupBy("_w").agg(F.count(F.lit(1)).alias("_often"))
    order = F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce("_often", F.lit(0)).alias("o"), F.col("_w").alias("w")))), lambda x: x["w"])
    ordered = lambda df, c: df.select(c, F.explode(word_list(c)).alias("_w")).join(often, "_w", "left").groupBy(c).agg(order.alias("_words"))
    parts = max(int(names.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * names.sparkSession.sparkContext.defaultParallelism)
    # similar names have lengths within a factor, so names meet in classes of length, each with its neighbours
    size = lambda c: F.floor(F.log(F.length(c).cast("double")) / math.log(1.001 * (2 - NEXT) / NEXT))
    whole = lambda c: F.ceil(c - 1e-9).cast("int")
    key = F.xxhash64("_w", "_m", "_size")

    y = ordered(known, "alias").withColumn("_m", F.size("_words")).withColumn("_size", size("alias")).withColumn("_long", F.length("alias"))
    y = y.select("alias", "_m", "_size", "_long", "_words", signs("alias").alias("y"))
    y = y.select("alias", "_m", "_size", "_long", "y.*", F.posexplode(F.slice("_words", F.lit(1), F.col("_m") - whole(LEAST_OVERLAP * F.col("_m")) + 1)).alias("_place", "_w"))
    index = counted_small(y.select(key.alias("_key"), "alias", "_long", "_place", *[F.col(c).alias(f"y{c}") for c in SIGNS]), INDEX_LIMIT)

    x = ordered(names, "_name").repartition(parts).withColumn("_n", F.size("_words")).select("_name", "_n", "_words", signs("_name").alias("x"))
    x = x.select("_name", "_n", "_words", "x.*", F.explode(F.sequence(whole(LEAST_OVERLAP * F.col("_n")), F.floor(F.col("_n") / LEAST_OVERLAP + 1e-9).cast("int"))).alias("_m"))
    x = x.withColumn("_t", whole(LEAST_OVERLAP / (1 + LEAST_OVERLAP) * (F.col("_n") + F.col("_m")))).withColumn("_w", F.explode(F.slice("_words", F.lit(1), F.col("_n") - F.col("_t") + 1)))
    x = x.withColumn("_size", F.explode(F.array(*[size("_name") + i for i in (-1, 0, 1)])))
    x = x.select(key.alias("_key"), "_name", F.length("_name").alias("_len"), (F.col("_m") - F.col("_t")).alias("_last"), *SIGNS)

    both, twice = F.col("_len") + F.col("_long"), REACH * (F.col("_len") + F.col("_long"))
    bits = lambda f, cs: reduce(add, [F.bit_count(f(F.col(c), F.col(f"y{c}"))) for c in cs])
    shared = bits(lambda a, b: a.bitwiseAND(b), SIGNS[:2]) + F.least("_more", "y_more")
    lost = bits(lambda a, b: a.bitwiseAND(F.bitwise_not(b)), SIGNS[3:])
    gained = bits(lambda a, b: b.bitwiseAND(F.bitwise_not(a)), SIGNS[3:])
    near = (F.col("_place") <= F.col("_last")) & (2 * F.least("_len", "_long") >= twice) & (2 * shared >= twice)
    near = near & (lost <= both + F.col("_len") - 1.5 * twice) & (gained <= both + F.col("_long") - 1.5 * twice)
    cand = x.join(index, "_key").where(near).where(F.call_function("levenshtein", "_name", "alias", F.floor(both - twice).cast("int")) >= 0)
    cand = cand.select("_name", "alias").repartition(parts, "_name").distinct()
    share = F.size(F.array_intersect(word_list("_name"), word_list("alias"))) / F.size(F.array_union(word_list("_name"), word_list("alias")))
    return cand.where(share >= LEAST_OVERLAP).withColumn("_s", ratio("_name", "alias")).where(F.col("_s") >= REACH)


def _looked_up(rows: DataFrame, cat: DataFrame) -> DataFrame:
    """rows with `_name` and what each exact step finds: `_rut`, `_a`, `_identifier`. cat: the catalog with its aliases as keys."""
    lookup = lambda c: small(cat.where(F.col(c).isNotNull() & (F.col(c).cast("string") != "")).groupBy(c).agg(F.min("entity").alias(f"_{c}")))
    r = rows.withColumn("_name", name_key(F.col("name")))
    return r.join(lookup("rut"), "rut", "left").join(lookup("alias").withColumnRenamed("alias", "_name").withColumnRenamed("_alias", "_a"), "_name", "left").join(lookup("identifier"), "identifier", "left")


def _judged(got: DataFrame, key: list[str], identifier_first: bool) -> DataFrame:
    """The first step that found something, with its confidence."""
    steps = [("_rut", "rut", 1.0), ("_a", "alias", 0.98), ("_identifier", "identifier", 0.97)]
    if identifier_first:
        steps = [steps[0], steps[2], steps[1]]
    method = F.when(F.lit(False), "")
    score = F.when(F.lit(False), F.lit(0.0))
    for c, m, s in steps:
        method, score = method.when(F.col(c).isNotNull(), m), score.when(F.col(c).isNotNull(), F.lit(s))
    method, score = method.when(F.col("_f").isNotNull(), "fuzzy").otherwise("unresolved"), score.when(F.col("_f").isNotNull(), F.col("_s")).otherwise(F.lit(0.0))
    return got.select(*key, F.coalesce(*[F.col(c) for c, _, _ in steps], "_f").alias("entidad"), method.alias("metodo"), score.alias("confianza"))


def exact(rows: DataFrame, catalog: DataFrame, key: list[str], identifier_first: bool = False) -> DataFrame:
    """The rows of `cascade` that tax id, alias or identifier resolve. These steps come before similarity, so none is computed."""
    got = _looked_up(rows, catalog.withColumn("alias", name_key(F.col("alias")))).where("_rut IS NOT NULL OR _a IS NOT NULL OR _identifier IS NOT NULL")
    return _judged(got.withColumns({"_f": F.lit(None), "_s": F.lit(0.0)}), key, identifier_first)


def cascade(rows: DataFrame, catalog: DataFrame, key: list[str], identifier_first: bool = False) -> DataFrame:
    """rows with `entidad`, `metodo`, `confianza`: by tax id, alias, identifier, then similarity; else unresolved.

    rows: key columns, rut, name, identifier. catalog: entity, rut, alias, identifier (nulls allowed). Of entities that share
    an alias the least counts. Similarity is only computed for names with a common word, distinct names once, and where letters
    leave it possible (`similar`). A best candidate that hardly leads the second, or an alias of two entities, stays unresolved.
    The order of alias and identifier is the caller's."""
    ship(rows.sparkSession)
    cat = catalog.withColumn("alias", name_key(F.col("alias")))
    got = _looked_up(rows, cat)
    left = got.where("_rut IS NULL AND _a IS NULL AND _identifier IS NULL AND _name <> ''").select("_name").distinct()
    aliases = cat.where("alias <> ''").select("alias", "entity").distinct().groupBy("alias").agg(F.min("entity").alias("entity"), F.count(F.lit(1)).alias("_of"))
    cand = similar(left, aliases.select("alias")).join(aliases, "alias")
    w = Window.partitionBy("_name").orderBy(F.desc("_s"), "entity", "alias")
    second = F.when(F.col("_of") > 1, F.col("_s")).otherwise(F.coalesce(F.lead("_s").over(w), F.lit(0.0)))
    ranked = cand.withColumn("_k", F.row_number().over(w)).withColumn("_next", second).where("_k = 1")
    fuzzy = ranked.where((F.col("_s") >= LEAST) & (F.col("_s") - F.col("_next") >= LEAD)).select("_name", F.col("entity").alias("_f"), "_s")
    return _judged(got.join(fuzzy, "_name", "left"), key, identifier_first)
