"""A corpus from raw documents to packed training sequences, in stages.

Every stage works on all rows that the one before has kept. Rows that repeat a ``doc_id`` are kept once; rows
without one are kept unless their text repeats exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickharbor.llm import tables
from tickharbor.llm.decontamination import without_leaks
from tickharbor.llm.language import in_known_language, is_held_out, learn, vocabulary_pieces
from tickharbor.llm.near_duplicates import near_duplicates
from tickharbor.llm.packing import pack
from tickharbor.llm.personal_data import masked
from tickharbor.llm.queries import PACK_END, PACK_VOCABULARY, PIECE_VOCABULARY, SEQUENCE
from tickharbor.session import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters, and those far less likely in any learned language than as even letters."""
    model = learn(docs.where(~is_held_out()), vocabulary_pieces(tables.vocabulary(PIECE_VOCABULARY)))
    return in_known_language(docs, model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of near duplicates; of rows that repeat its id, one."""
    kept = near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(key))
    known = (docs.join(kept.hint("merge"), "doc_id", "left_semi").select(*docs.columns, first.alias("__first"))
             .where("__first = 1").drop("__first"))
    nameless = docs.where("doc_id IS NULL").withColumn("__key", key).dropDuplicates(["__key"]).drop("__key")
    return known.select(*docs.columns).unionByName(nameless)


def no_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return without_leaks(docs, tables.read(spark, sf_dir, "benchmark"))


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put a mark in the place of personal data, and count the characters anew."""
    size = F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars"))
    return masked(docs).withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return pack(docs, tables.vocabulary(PACK_VOCABULARY), PACK_END, SEQUENCE, keep_encoder=False)


STAGES: list[tuple[str, Stage]] = [
    ("language", known_languages),
    ("near_duplicates", one_of_each_group),
    ("decontamination", no_benchmark_leaks),
    ("personal_data", no_personal_data),
    ("packing", packed_sequences),
]

# Scores, singular vectors and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again before the next."""
    docs = tables.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
