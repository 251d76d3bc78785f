"""From raw documents to a sharded training corpus, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, language, mixing, sharding, simhash
from tidemark.llm.common import whole_row
from tidemark.llm.queries import language_model, table
from tidemark.session import new_folder, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A text stays if one language holds at least this share of its letters.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a language: those without a letter, or without a language that holds half of the
    letters, go. The model learns from the rows that are not held out."""
    found = language.identify(docs.select(whole_row(docs), "text"), language_model(docs), ["row"])
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.drop_near_duplicates(docs, shingle=3, distance=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten words in a row of a benchmark item occur."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"), length=10)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: none, once or twice."""
    return mixing.mixed(docs, weights=(5, 2, 1), share=1.5, limit=2)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ``virtual_slot`` and ``shard``, 24 shards of nearly equal bytes."""
    text = F.coalesce("text", F.lit(""))
    key = [F.col("doc_id"), F.crc32(text.cast("binary"))]
    return sharding.assign(docs, key, F.octet_length(text) + 8, 24, new_folder(spark, "slot-map"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("mixing_sources", mix),
    ("sharding", shard),
]

#: Language labels and SimHash groups are beyond SQL; the tests hold every stage against a
#: brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
