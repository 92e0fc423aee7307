"""From raw documents to token ids: five stages, each over everything its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alula.llm import exact_dedup, language_id, minhash, mixing, pieces
from alula.llm.common import held_out, written
from alula.session import ship_package

#: A vocabulary file of the public tokenizers.
PIECE_MODEL = "piece_bpe_32k.model"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those that no learnt language claims."""
    ship_package(spark)
    model = language_id.train_language_id(docs, ~held_out(F.col("doc_id")))
    return language_id.claimed_rows(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return minhash.drop_near_duplicates(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents so that the labelled domains come near their target weights."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(F.col("doc_id")))
    return mixing.mixed_rows(docs, mixing.label_domains(labels))


def encode_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with the check that they decode to its text."""
    ship_package(spark)
    found = pieces.encode_pieces(docs, public_tokenizers.path(PIECE_MODEL), ["doc_id", "lang", "source"])
    return found.select("doc_id", "lang", "source", F.col("__pieces").alias("pieces"), F.size("__pieces").alias("n_pieces"), F.col("__round_trip").alias("round_trip"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("soft_mixing", mix_domains),
    ("sentencepiece", encode_text),
]

#: Learnt models decide in two stages, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
