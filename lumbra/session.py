"""Session helpers: sizes known to the optimizer, guarded broadcasts, durable checkpoints, code shipping."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Largest optimizer estimate, in bytes, of a side that is broadcast explicitly.
BROADCAST_LIMIT = 32 << 20
#: An estimate from here on says that the optimizer doesn't know; buckets beyond this number gain nothing.
UNKNOWN_BYTES, MOST_BUCKETS = 1 << 60, 1_000_000
#: Bytes of input that one bucket of a grouped Python operator should hold.
BUCKET_BYTES = 24 << 20


def local_session(app: str = "lumbra", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LUMBRA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the size of a plan's output; costs no job. It says nothing of columns that hold many values."""
    if any(isinstance(f.dataType, T.ArrayType | T.MapType) for f in df.schema):
        return UNKNOWN_BYTES
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Marks a side for broadcast if its estimated size is within the limit; else leaves the join to AQE."""
    return F.broadcast(df) if plan_bytes(df) <= limit else df


def buckets_for(*sides: DataFrame, bucket_bytes: int = BUCKET_BYTES, least: int = 1) -> int:
    """Number of hash buckets so that each holds about bucket_bytes; grows with the data.

    Parquet is compressed and Python holds it expanded, hence the factor."""
    spark = sides[0].sparkSession
    total = sum(n for n in map(plan_bytes, sides) if n < UNKNOWN_BYTES) * 4
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(MOST_BUCKETS, max(least, parts, -(-total // bucket_bytes)))


def checkpointed(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the folder that the cluster names.

    Only where no folder is set, as in tests on one machine, a temporary one is chosen."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if named is None:
            named = tempfile.mkdtemp(prefix="lumbra-checkpoint-")
            atexit.register(shutil.rmtree, named, True)
        sc.setCheckpointDir(named)
    return df.checkpoint(eager)


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per context."""
    sc = spark.sparkContext
    if getattr(sc, "_lumbra_shipped", False):
        return
    root = Path(__file__).resolve().parent
    handle, name = tempfile.mkstemp(prefix="lumbra-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, f"{root.name}/{path.relative_to(root)}")
    sc.addPyFile(name)
    atexit.register(Path(name).unlink, True)
    sc._lumbra_shipped = True


def _row_bytes(df: DataFrame) -> Column:
    """About what a row takes: the bytes of texts, what nested values take as JSON, 16 for anything else."""
    size = F.lit(16).cast("long")
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType | T.BinaryType):
            size = size + F.coalesce(F.octet_length(c), F.lit(0)) + 16
        elif isinstance(f.dataType, T.ArrayType | T.MapType | T.StructType):
            size = size + F.coalesce(F.length(F.to_json(F.struct(c))), F.lit(0)) * 2
        else:
            size = size + 16
    return size


def counted_small(df: DataFrame, limit: int = BROADCAST_LIMIT, written: bool = False) -> DataFrame:
    """Measures a side and marks it for broadcast only if its rows take at most `limit` bytes; materialises it before, unless it is a part of something written."""
    df = df if written else checkpointed(df)
    return F.broadcast(df) if (df.agg(F.sum(_row_bytes(df))).first()[0] or 0) <= limit else df


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as there are cores, for costly work on a few large files; where it has them already nothing moves."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.rdd().getNumPartitions() < cores else df
