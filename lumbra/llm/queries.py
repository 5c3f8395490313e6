"""Queries of the operators on text. SQL can't express them; tests hold them against brute force, round trips and held-out hosts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbra.llm import encoding, mixing, names, packing, residue, tokens
from lumbra.session import checkpointed, table

Query = Callable[[SparkSession, str], DataFrame]


def _garbled(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.garbled_names(table(spark, folder, "cmf_v2024"), table(spark, folder, "contrapartes"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return _garbled(spark, folder).select("tabla", "clave").distinct()


def p5_repaired(spark: SparkSession, folder: str) -> DataFrame:
    """The affected rows with their right spelling; entero tells whether all of it could be restored."""
    return _garbled(spark, folder)


def _linked(spark: SparkSession, folder: str) -> DataFrame:
    return names.link_spellings(names.spellings_of(table(spark, folder, "fact_derivado"), table(spark, folder, "cmf_v2024")))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return names.same_entity(checkpointed(_linked(spark, folder)))


def p6_entities(spark: SparkSession, folder: str) -> DataFrame:
    """One row per spelling with its entity and the number of the entity's other spellings."""
    got = checkpointed(_linked(spark, folder))
    return got.join(got.groupBy("entidad").agg((F.count(F.lit(1)) - 1).alias("enlaces")), "entidad").select("nombre_id", "entidad", "enlaces")


def _sized(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.sized(table(spark, folder, "documents").select("doc_id", "text", "source"))


def p8_packed(spark: SparkSession, folder: str) -> DataFrame:
    """Where each document, or each cut part of one, goes."""
    return packing.packed(_sized(spark, folder).select("doc_id", "n_tokens"))


def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    return packing.fill(p8_packed(spark, folder))


def p9_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """The mixture: shard, reading order, document, repetition."""
    return mixing.mixed(_sized(spark, folder), table(spark, folder, "mezcla_objetivo"))


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The shares really reached."""
    return mixing.shares(p9_mixture(spark, folder), table(spark, folder, "mezcla_objetivo"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return residue.residue(table(spark, folder, "documents")).select("doc_id")


def p10_passages(spark: SparkSession, folder: str) -> DataFrame:
    """The excluded documents with the passage that excludes them."""
    return residue.residue(table(spark, folder, "documents"))


def p10_kept(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that stay."""
    docs = table(spark, folder, "documents")
    return docs.join(residue.residue(docs).select("doc_id"), "doc_id", "left_anti")


def p10_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Agreement on hosts that the training didn't see."""
    return residue.validation(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (p5_found, p5_repaired, p6_found, p6_entities, p8_packed, p8_fill, p9_mixture, p9_shares, p10_found, p10_passages, p10_kept, p10_validation)}
ORACLE: dict[str, str] = {}
