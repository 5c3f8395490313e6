"""Filings as a stream of files, and windows over desk events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lumbra.operators import parsing
from lumbra.sources.files import merge_lines


def ingest(spark: SparkSession, landing: str, schema: str, path: str, quarantine: str, checkpoint: str) -> StreamingQuery:
    """Loads raw lines that land as Parquet: valid ones and rejected ones go to their tables by merge_lines, so an archive may
    land in parts, and one delivered again replaces what it brought before. Runs over what is there and ends. Whether a
    publication is current is a matter of the batch view."""
    lines = spark.readStream.schema(schema).parquet(landing)

    def batch(df: DataFrame, _: int) -> None:
        merge_lines(parsing.split_rows(df), F.col("_motivo").isNotNull(), path, quarantine)

    return lines.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_windows(events: DataFrame, late: str = "2 hours", width: str = "1 day", ts: str = "ts", kind: str = "tipo_evento") -> DataFrame:
    """(desde, hasta, tipo, n): events a window and kind; events later than `late` are dropped. Works on streams and tables."""
    timed = events.where(F.col(ts).isNotNull()).withColumn("_ts", F.col(ts).cast("timestamp"))
    w = timed.withWatermark("_ts", late).groupBy(F.window("_ts", width).alias("w"), F.col(kind).alias("tipo")).agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("w.start").alias("desde"), F.col("w.end").alias("hasta"), "tipo", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours", ts: str = "ts", key: str = "rut_compania") -> DataFrame:
    """(key, desde, hasta, n): events of a key that follow each other within the gap."""
    timed = events.where(F.col(ts).isNotNull()).withColumn("_ts", F.col(ts).cast("timestamp"))
    w = timed.withWatermark("_ts", late).groupBy(F.col(key), F.session_window("_ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return w.select(key, F.col("w.start").alias("desde"), F.col("w.end").alias("hasta"), "n")
