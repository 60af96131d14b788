"""The registered queries of the operators, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickharbor.llm import tables
from tickharbor.llm.chat import chat_fragments
from tickharbor.llm.decontamination import leaks
from tickharbor.llm.divergence import source_divergence
from tickharbor.llm.extraction import main_text
from tickharbor.llm.fingerprints import edited_fingerprints
from tickharbor.llm.hard_negatives import hard_negatives
from tickharbor.llm.language import languages, vocabulary_pieces
from tickharbor.llm.near_duplicates import near_duplicates
from tickharbor.llm.near_vectors import near_vectors
from tickharbor.llm.oracles import DIVERGENCE, HARD_NEGATIVES, NEAR_DUPLICATES, NEAR_VECTORS, REPEATS
from tickharbor.llm.packing import pack
from tickharbor.llm.personal_data import personal_data, spans_text
from tickharbor.llm.repeats import without_repeats
from tickharbor.llm.token_files import read_token_files, write_token_files

# Vocabularies of public tokenizers and the ids that end a document.
FILE_VOCABULARY, FILE_END = "word_bpe_49k.json", 1
PIECE_VOCABULARY = "piece_bpe_32k.model"
PACK_VOCABULARY, PACK_END, SEQUENCE = "byte_bpe_50k.json", 2, 1024
# Anchors of the search for negatives, and rows whose label moves on to the next of so many.
ANCHOR_STEP, MOVED_STEP, LABELS = 50, 7, 10


def op1_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return edited_fingerprints(tables.documents(spark, folder))


def op2_languages(spark: SparkSession, folder: str) -> DataFrame:
    return languages(tables.documents(spark, folder), vocabulary_pieces(tables.vocabulary(PIECE_VOCABULARY)))


def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(tables.documents(spark, folder)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), spans_text().alias("spans"))


def op4_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(tables.read(spark, folder, "pages"))


def op5_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(tables.documents(spark, folder), tables.read(spark, folder, "benchmark"))


def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat_fragments(tables.read(spark, folder, "conversations"))


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    manifest = write_token_files(tables.documents(spark, folder), tables.vocabulary(FILE_VOCABULARY), FILE_END)
    return read_token_files(manifest)


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(tables.documents(spark, folder), tables.vocabulary(PACK_VOCABULARY), PACK_END, SEQUENCE)


def op9_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(tables.documents(spark, folder))


def op10_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(tables.documents(spark, folder)).drop("removed")


def op11_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(tables.read(spark, folder, "embeddings"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % MOVED_STEP == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return hard_negatives(tables.read(spark, folder, "embeddings").withColumn("label", moved), ANCHOR_STEP)


def op13_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence(tables.documents(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chunks": op1_chunks,
    "op2_languages": op2_languages,
    "op3_personal_data": op3_personal_data,
    "op4_main_text": op4_main_text,
    "op5_leaks": op5_leaks,
    "op6_chat": op6_chat,
    "op7_token_files": op7_token_files,
    "op8_packing": op8_packing,
    "op9_minhash": op9_minhash,
    "op10_repeats": op10_repeats,
    "op11_near_vectors": op11_near_vectors,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_divergence": op13_divergence,
}

# Tokenizers, fitted models, hashes of chunks and lenient page parsing are beyond SQL; tests hold those queries against brute force.
ORACLES: dict[str, str] = {
    "op9_minhash": NEAR_DUPLICATES,
    "op10_repeats": REPEATS,
    "op11_near_vectors": NEAR_VECTORS,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_divergence": DIVERGENCE,
}
