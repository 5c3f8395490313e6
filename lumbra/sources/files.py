"""Readers and writers of the other formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbra.session import checkpointed


#: Partition columns of a fact: an archive's rows of one period.
ARCHIVE = ("periodo_informacion", "zip_origen")
#: Natural key of a filed line.
LINE = ("zip_origen", "source_file", "line_no")


def warehouse(spark: SparkSession, path: str) -> DataFrame:
    """A fact's files, whatever columns each has; partition folders become columns of text, as their names say."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")  # else an archive named 0012 reads as the number 12
    try:
        return spark.read.option("mergeSchema", True).option("basePath", path).parquet(path)
    finally:
        spark.conf.set(key, before)


def _held(df: DataFrame, path: str, partitions: tuple[str, ...]) -> DataFrame | None:
    """What the partitions that df touches hold now, cut from the files so that they may be written over; null if nothing was written yet."""
    spark = df.sparkSession
    if not _exists(spark, path):
        return None
    now = warehouse(spark, path)
    now = now.withColumns({c: F.col(c).cast(df.schema[c].dataType) for c in partitions})
    return checkpointed(now.join(df.select(*partitions).distinct(), list(partitions), "left_semi"))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return False
    found = fs.listFiles(p, True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def _overwrite(df: DataFrame, path: str, partitions: tuple[str, ...]) -> None:
    """Replaces df's partitions. Rebalancing keeps small archives in one file each and splits a hot one."""
    df.hint("rebalance", *partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*partitions).parquet(path)


def write_fact(df: DataFrame, path: str, partitions: tuple[str, ...] = ARCHIVE, letters: list[str] | None = None) -> None:
    """Writes a fact; a second load of an archive replaces only that archive's partition.

    letters makes it a partial load: of the archives in df only rows of these letters (column `letra`) are replaced, the
    others' rows stay. Columns that only one load has are null in the other's rows. An empty df changes nothing."""
    if letters is not None:
        df = df.where(F.col("letra").isin(letters))
        held = _held(df, path, partitions)
        if held is not None:
            df = held.where(~F.coalesce(F.col("letra").isin(letters), F.lit(False))).unionByName(df, allowMissingColumns=True)
    _overwrite(df, path, partitions)


def merge_lines(rows: DataFrame, bad: Column, path: str, quarantine: str) -> None:
    """Merges filed lines into two facts: those where `bad` holds go to quarantine, the others to path.

    A line replaces the one of its natural key, in whichever fact that is; a file (zip_origen, source_file) downloaded later
    replaces all lines of the earlier download, and lines of an earlier download that arrive late are not taken. So lines of a
    file may arrive in several batches, a batch may be repeated, and a redelivery that has no rejects leaves none behind. A null
    download counts as the earliest. What is rewritten are the archives that the batch touches."""
    spark = rows.sparkSession
    rows = checkpointed(rows.withColumn("_bad", F.coalesce(bad, F.lit(False))))
    sides = [(path, False), (quarantine, True)]
    held = [(h.withColumn("_bad", F.lit(flag)), flag) for p, flag in sides if (h := _held(rows, p, ARCHIVE)) is not None]
    every = rows
    for h, _ in held:
        every = every.unionByName(h.join(rows.select(*LINE).distinct(), list(LINE), "left_anti"), allowMissingColumns=True)
    at = F.coalesce("fecha_descarga", F.lit("1900-01-01").cast("date"))
    newest = every.groupBy("zip_origen", "source_file").agg(F.max(at).alias("_newest"))
    live = checkpointed(every.join(newest, ["zip_origen", "source_file"]).where(at == F.col("_newest")).drop("_newest"))
    for p, flag in sides:
        part = live.where(F.col("_bad") == flag).drop("_bad")
        _overwrite(part, p, ARCHIVE)
        if any(f == flag for _, f in held):
            emptied = rows.select(*ARCHIVE).distinct().join(part.select(*ARCHIVE).distinct(), list(ARCHIVE), "left_anti")
            for r in emptied.toLocalIterator():  # archives of a batch at most; each is one file operation
                _drop(spark, p, r.asDict())


def _drop(spark: SparkSession, path: str, partition: dict) -> None:
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    p = spark._jvm.org.apache.hadoop.fs.Path("/".join([path, *(f"{c}={escape(str(v))}" for c, v in partition.items())]))
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def series_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(closes, days) of a file {cierres: {AAAAMM: {fecha, valor}}, dias: {date: value}}."""
    raw = spark.read.schema("cierres map<string, struct<fecha: string, valor: double>>, dias map<string, double>").json(path, multiLine=True)
    closes = raw.select(F.explode("cierres").alias("p", "c")).select(F.col("p").cast("int").alias("periodo"), F.to_date("c.fecha").alias("fecha"), F.col("c.valor").alias("valor"))
    return closes, raw.select(F.explode("dias").alias("d", "valor")).select(F.to_date("d").alias("fecha"), "valor")


def commented_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, lines that start with # left out, quotes doubled inside quotes."""
    return spark.read.option("comment", "#").option("header", True).option("escape", '"').option("quote", '"').csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object a row, such as the counters of a run."""
    df.write.mode("overwrite").json(path)


def yaml_catalog(spark: SparkSession, path: str) -> DataFrame:
    """catalog() of a YAML file {entities: [...]} or [...]; needs a YAML parser on the driver."""
    import yaml

    text = "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())  # one catalog file
    parsed = yaml.safe_load(text)
    return catalog(spark, parsed["entities"] if isinstance(parsed, dict) else parsed or [])


def catalog(spark: SparkSession, entities: list[dict]) -> DataFrame:
    """(entity, parent, rut, alias, identifier) from a list such as a parsed catalog gives; a row for each key of an entity. A parent that is no entity is null."""
    known = {e["key"] for e in entities}
    rows = []
    for e in entities:
        parent = e.get("parent") if e.get("parent") in known else None
        rows += [(e["key"], parent, int(r), None, None) for r in e.get("ruts", [])]
        rows += [(e["key"], parent, None, a, None) for a in [e.get("name"), *e.get("aliases", [])] if a]
        rows += [(e["key"], parent, None, None, i.strip().upper()) for i in e.get("identifiers", [])]
    return spark.createDataFrame(rows, "entity string, parent string, rut long, alias string, identifier string")


def portable(facts: dict[str, DataFrame], dims: dict[str, DataFrame], path: str, months: int, period: str = "periodo_informacion") -> None:
    """The last months of each fact and whole dimensions, as Parquet under path."""
    for name, f in facts.items():
        last = f.select(period).distinct().orderBy(F.desc(period)).limit(months)
        f.join(F.broadcast(last), period, "left_semi").write.mode("overwrite").parquet(f"{path}/{name}")  # months rows
    for name, f in dims.items():
        f.write.mode("overwrite").parquet(f"{path}/{name}")


def dictionary(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(tabla, columna, tipo) of every column."""
    return spark.createDataFrame([(t, f.name, f.dataType.simpleString()) for t, df in tables.items() for f in df.schema], "tabla string, columna string, tipo string")
