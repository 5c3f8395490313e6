"""Attributes as known at event time.

Events and versions are co-grouped by entity hash bucket; inside a bucket one sorted array of
(entity, day on which a version is usable) is searched for all events at once. A version is usable
from the day on which it is both valid and recorded; of all usable ones the greatest rank
(period, then record day) wins, which is a running maximum along that array. So a version that
never wins on its day is dropped by a map-side combined aggregate, an entity keeps at most one
version a day, and an entity with very many events can be split over salted buckets while only
its bounded version list is copied.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbra.session import buckets_for, counted_small, ship

#: Events of one entity above which they are spread over several buckets.
HOT_EVENTS = 200_000


def _search(left: pa.Table, right: pa.Table, n_keys: int, carried: list[str], schema: pa.Schema) -> pa.Table:
    """left: keys, day, row columns; right: keys, usable day, rank columns, carried columns."""
    if not left.num_rows or not right.num_rows:
        return schema.empty_table()
    both = [
        pa.chunked_array([*left.column(f"_k{i}").chunks, *right.column(f"_k{i}").chunks]).combine_chunks().dictionary_encode()
        for i in range(n_keys)
    ]
    code = np.zeros(left.num_rows + right.num_rows, dtype=np.int64)
    for col in both:  # dense after each step, so the product can't overflow
        idx = col.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        code = np.unique(code * len(col.dictionary) + idx, return_inverse=True)[1].astype(np.int64)
    le, ri = code[: left.num_rows], code[left.num_rows :]
    day = right.column("_usable").to_numpy()
    period, seen = right.column("_period").to_numpy(), right.column("_seen").to_numpy()
    order = np.lexsort((seen, period, day, ri))
    ri, day, period, seen = ri[order], day[order], period[order], seen[order]
    rank = np.unique(period.astype(np.int64) * (1 << 24) + seen, return_inverse=True)[1].astype(np.int64)
    # running maximum of the rank inside each entity: entities ascend, so adding a step per entity keeps it inside
    step = np.int64(len(rank) + 1)
    top = np.maximum.accumulate(ri * step + rank)
    first = np.flatnonzero(top == ri * step + rank)  # positions where a version takes the lead
    winner = first[np.searchsorted(first, np.arange(len(ri)), side="right") - 1]
    low = min(int(day.min()), int(left.column("_day").to_numpy().min()))
    width = np.int64(max(int(day.max()), int(left.column("_day").to_numpy().max())) - low + 2)
    at = np.searchsorted(ri * width + (day - low), le * width + (left.column("_day").to_numpy() - low), side="right") - 1
    ok = (at >= 0) & (ri[np.maximum(at, 0)] == le)
    rows = np.flatnonzero(ok)
    pick = order[winner[at[rows]]]
    found = {c: left.column(c).take(pa.array(rows)) for c in schema.names if c in left.column_names}
    found |= {c: right.column(c).take(pa.array(pick)) for c in carried}
    # copies of an event fall into one bucket, so they are dropped here and not by a shuffle of their own
    return pa.table([pc.cast(found[f.name], f.type) for f in schema], schema=schema).group_by(schema.names, use_threads=False).aggregate([]).select(schema.names)


def latest_known(
    events: DataFrame,
    versions: DataFrame,
    keys: list[str],
    event_id: list[str],
    event_day: str,
    valid_from: str,
    recorded: str,
    period: str,
    carried: list[str],
    hot_events: int = HOT_EVENTS,
) -> DataFrame:
    """For each event the version of its entity with the greatest (period, recorded) that is valid and recorded by the event's day.

    events: keys, event_id columns, event_day (date or timestamp). versions: keys, valid_from (date), recorded
    (date), period (int), carried columns. Returns event_id + carried, one row per event with a version.
    Events or versions with a null in a key or a date have no match. Repeated events come out once;
    versions that tie in period and recorded are ordered by the carried columns, greatest first.
    Other columns of either side are ignored, so clashing names do no harm. Empty inputs give an empty result.
    """
    spark = events.sparkSession
    ship(spark)
    k = [F.col(c).cast("string").alias(f"_k{i}") for i, c in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    e = events.select(*k, *[F.col(c).alias(f"_e{i}") for i, c in enumerate(event_id)], F.unix_date(F.to_date(event_day)).alias("_day"))
    e = e.dropna(subset=[*names, "_day"])
    v = versions.select(*k, F.unix_date(F.to_date(recorded)).alias("_seen"), F.unix_date(F.to_date(valid_from)).alias("_valid"), F.col(period).cast("int").alias("_period"), *carried)
    v = v.dropna(subset=[*names, "_seen", "_valid", "_period"])
    v = v.withColumn("_usable", F.greatest("_seen", "_valid"))
    best = F.max(F.struct("_period", "_seen", *carried)).alias("_best")
    v = v.groupBy(*names, "_usable").agg(best).select(*names, "_usable", "_best.*")

    n = buckets_for(events.select(*keys, *event_id, event_day), versions.select(*keys, recorded, period, *carried))
    hot = e.groupBy(*names).count().where(F.col("count") > hot_events).select(*names, F.ceil(F.col("count") / hot_events).cast("int").alias("_parts"))
    hot = counted_small(hot)  # at most events / hot_events rows
    e = e.join(hot, names, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    e = e.withColumn("_salt", F.pmod(F.xxhash64(*[f"_e{i}" for i in range(len(event_id))]), F.col("_parts")).cast("int"))
    v = v.join(hot, names, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
    bucket = F.pmod(F.xxhash64(*names, "_salt"), F.lit(n)).alias("_bucket")
    left = e.select(bucket, *names, "_day", *[f"_e{i}" for i in range(len(event_id))])
    right = v.select(bucket, *names, "_usable", "_period", "_seen", *carried)
    out = T.StructType([*[T.StructField(f"_e{i}", e.schema[f"_e{i}"].dataType) for i in range(len(event_id))], *[v.schema[c] for c in carried]])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out)
    n_keys = len(keys)

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        return _search(a, b, n_keys, carried, arrow)

    got = left.groupBy("_bucket").cogroup(right.groupBy("_bucket")).applyInArrow(run, out)
    return got.select(*[F.col(f"_e{i}").alias(c) for i, c in enumerate(event_id)], *carried)


def desk_event_lines(events: DataFrame, lines: DataFrame, carried: list[str] | None = None, **options) -> DataFrame:
    """Each desk event with the derivative line of its position as it was known that day.

    A line is usable from the later of its download date and the close of its period."""
    lines = lines.withColumn("_close", F.last_day(F.to_date(F.concat(F.col("periodo_informacion").cast("string"), F.lit("01")), "yyyyMMdd")))
    return latest_known(
        events, lines, ["rut_compania", "folio_operacion", "item_operacion"], ["evento_id"], "ts", "_close", "fecha_descarga",
        "periodo_informacion", ["zip_origen", "source_file", "line_no", *(carried or [])], **options,
    )
