"""What changed between full snapshots: Merkle-tree digests compared top-down, rows only where leaves differ.

Keys of a snapshot fall into hash ranges (leaves), as many as keep a leaf at some rows, whatever the snapshot's size; a
leaf's digest adds up its rows' hashes, so it is a map-side combined aggregate over the rows, made once and written.
Inner digests hash their children in order, level by level up to the root. Consecutive snapshots of an owner are
compared at the root, then at the children of unequal nodes only, down to the leaves; rows are read again and compared
only in unequal leaves. Work on rows follows what changed, not what exists, and no group larger than a leaf's rows of
one snapshot ever meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbra.session import checkpointed, counted_small

#: Children of an inner node, rows that a leaf should hold, and most levels (leaves beyond 2^40 gain nothing).
FANOUT, LEAF_ROWS, MOST_LEVELS = 16, 64, 10


def levels_for(rows: int) -> int:
    """Levels below the root, so that a leaf of a snapshot of so many rows holds about LEAF_ROWS."""
    d = 1
    while d < MOST_LEVELS and FANOUT**d * LEAF_ROWS < rows:
        d += 1
    return d


def _leaf(key: list[str], levels: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(FANOUT**levels))


def leaf_digests(rows: DataFrame, owner: list[str], key: list[str], content: list[Column], levels: int) -> DataFrame:
    """(owner columns, _node, _digest): one row a leaf of a snapshot. rows: one row a key."""
    h, h2 = F.xxhash64(*key, *content), F.hash(*key, *content).cast("long")
    leaf = rows.select(*owner, _leaf(key, levels).alias("_node"), h.alias("_h"), h2.alias("_h2"))
    return leaf.groupBy(*owner, "_node").agg(
        F.xxhash64(F.count(F.lit(1)), F.bit_xor("_h"), F.sum(F.col("_h").bitwiseAND(F.lit((1 << 40) - 1))), F.sum("_h2")).alias("_digest")
    )


def _parents(digests: DataFrame, owner: list[str]) -> DataFrame:
    """Digests of the level above; FANOUT children a node at most."""
    up = digests.select(*owner, F.floor(F.col("_node") / FANOUT).alias("_up"), F.struct("_node", "_digest").alias("_d"))
    return up.groupBy(*owner, "_up").agg(F.xxhash64(F.array_sort(F.collect_list("_d"))).alias("_digest")).withColumnRenamed("_up", "_node")


def unequal_leaves(leaves: DataFrame, owner: str, when: str, levels: int) -> DataFrame:
    """(owner, when, _before, _node): the leaves in which a snapshot differs from the owner's snapshot before it, found from the root down."""
    order = Window.partitionBy(owner).orderBy(when)  # one row a snapshot
    pairs = leaves.select(owner, when).distinct().withColumn("_before", F.lag(when).over(order)).where("_before IS NOT NULL")
    pairs = checkpointed(pairs)
    tree = [leaves]
    for _ in range(levels):
        tree.append(_parents(tree[-1], [owner, when]))
    left = None
    at = [owner, when, "_before"]
    for digests in reversed(tree):
        # each digest once as the later and once as the earlier of a pair; one aggregate compares them
        both = digests.join(pairs, [owner, when]).select(*at, "_node", F.col("_digest").alias("_new"), F.lit(None).cast("long").alias("_old"))
        old = digests.withColumnRenamed(when, "_before").join(pairs, [owner, "_before"]).select(*at, "_node", F.lit(None).cast("long").alias("_new"), F.col("_digest").alias("_old"))
        both = both.unionByName(old)
        if left is not None:
            up = left.withColumnRenamed("_node", "_up")
            both = both.withColumn("_up", F.floor(F.col("_node") / FANOUT)).join(up, [*at, "_up"], "left_semi").drop("_up")
        both = both.groupBy(*at, "_node").agg(F.max("_new").alias("_new"), F.max("_old").alias("_old"))
        left = both.where("NOT _new <=> _old").select(*at, "_node")
    return left


def consecutive_changes(
    snaps: DataFrame,
    owner: str,
    when: str,
    key: str,
    content: list[Column],
    changed: Column,
    shown: list[str],
) -> DataFrame:
    """(when, owner, key, cambio, shown columns now and as *_prev) for each key added, removed or changed since the owner's previous snapshot.

    snaps: one row per owner, when and key, already normalised and written. content: what the digests cover, at least as
    fine as the test `changed`, which reads columns n.* and o.*. An owner's first snapshot gives no rows. An
    empty table gives no rows. A null key never occurs here: the caller drops it.
    """
    largest = snaps.groupBy(owner, when).count().agg(F.max("count")).first()[0] or 0
    levels = levels_for(largest)
    leaves = checkpointed(unequal_leaves(checkpointed(leaf_digests(snaps, [owner, when], [key], content, levels)), owner, when, levels))
    rows = snaps.select(owner, when, key, F.struct(*shown).alias("_r"), _leaf([key], levels).alias("_node"))
    new = rows.join(leaves, [owner, when, "_node"]).select(owner, when, key, F.col("_r").alias("_n"), F.lit(None).cast(rows.schema["_r"].dataType).alias("_o"))
    old = rows.withColumnRenamed(when, "_before").join(leaves, [owner, "_before", "_node"]).select(owner, when, key, F.lit(None).cast(rows.schema["_r"].dataType).alias("_n"), F.col("_r").alias("_o"))
    both = new.unionByName(old).groupBy(owner, when, key).agg(F.max("_n").alias("n"), F.max("_o").alias("o"))
    cambio = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(changed, "changed")
    both = both.withColumn("cambio", cambio).where("cambio IS NOT NULL")
    return both.select(when, owner, key, "cambio", *[F.col(f"n.{c}").alias(c) for c in shown], *[F.col(f"o.{c}").alias(f"{c}_prev") for c in shown])


def clean_positions(positions: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """One row per company, month and folio of the last delivered snapshot of each month, with the columns `more` of that row.

    Of a month delivered twice the later download counts as a whole (a null download is the earliest).
    Case, blanks and zero padding are removed; repeats that differ in writing fall together, the least
    of their values being kept. Rows without company, month or a numeric folio are left out.
    """
    p = positions.select(
        "periodo", "rut_compania", F.regexp_replace("folio_operacion", r"\s+", "").try_cast("bigint").alias("folio_operacion"),
        F.coalesce("fecha_descarga", F.lit("1900-01-01").cast("date")).alias("_at"), F.upper(F.trim("moneda")).alias("moneda"),
        F.upper(F.trim("contraparte_key")).alias("contraparte_key"), F.col("fecha_vencimiento").cast("date").alias("fecha_vencimiento"),
        F.col("nocional_m").cast("double").alias("nocional_m"), *more,
    ).dropna(subset=["periodo", "rut_compania", "folio_operacion"])
    last = p.groupBy("rut_compania", "periodo").agg(F.max("_at").alias("_at"))
    p = p.join(counted_small(last), ["rut_compania", "periodo", "_at"])  # a row a company and month
    one = F.min(F.struct("moneda", "contraparte_key", "fecha_vencimiento", "nocional_m", *more)).alias("_r")
    return p.groupBy("rut_compania", "periodo", "folio_operacion").agg(one).select("rut_compania", "periodo", "folio_operacion", "_r.*")


#: A notional counts as changed beyond this difference.
NOTIONAL_STEP = 0.001


def position_changes(positions: DataFrame) -> DataFrame:
    """Positions that came, went or changed since the company's previous delivered month, with both notionals."""
    snaps = checkpointed(clean_positions(positions))  # read by the count, the digests and the rows
    # equal to the nearest step means a difference within the step, so the digest is never coarser than the test
    content = [F.round(F.col("nocional_m") / NOTIONAL_STEP).cast("decimal(38,0)").cast("string"), F.col("fecha_vencimiento"), F.col("moneda"), F.col("contraparte_key")]
    content = [F.coalesce(c.cast("string"), F.lit("\0")) for c in content]
    differs = ~F.coalesce(F.abs(F.col("n.nocional_m") - F.col("o.nocional_m")) <= NOTIONAL_STEP, F.col("n.nocional_m").isNull() & F.col("o.nocional_m").isNull())
    for c in ("fecha_vencimiento", "moneda", "contraparte_key"):
        differs = differs | ~F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}"))
    shown = ["nocional_m", "fecha_vencimiento", "moneda", "contraparte_key"]
    return consecutive_changes(snaps, "rut_compania", "periodo", "folio_operacion", content, differs, shown)
