"""A corpus pipeline of five stages over `documents`; each stage takes what its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriflux.llm import contamination, language, mixing, near_copies, token_files
from veriflux.llm.queries import END_ID, TOKENIZER, VOCABULARY
from veriflux.llm.store import stored
from veriflux.session import shared_dir, ship_library


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those that no language fits. The model learns from the labels in docs."""
    ship_library(spark)
    model = language.train(docs.filter(~language.is_held_out(F.col("doc_id"))))
    return language.keep_identified(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one with the least id."""
    ship_library(spark)
    return near_copies.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    ship_library(spark)
    return contamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and samples documents until each source has its share of words."""
    ship_library(spark)
    return mixing.repeated(mixing.mix(docs))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token files and reads them back: one row for each document in them, copies included."""
    ship_library(spark)
    folder = shared_dir(spark, "tokens")
    token_files.write(docs, folder, public_tokenizers.path(TOKENIZER), END_ID)
    return token_files.read(spark, folder, VOCABULARY).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("language_id", identify_language), ("near_copies", drop_near_copies), ("decontamination", decontaminate),
    ("mixing", mix_sources), ("token_files", write_tokens),
]

# A learned model decides in the first stage. Tests compare run() with the stages one by one, near_copies with its
# operator and the ids of token_files with its input; plain versions check the operators, not the pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written below spark.checkpoint.dir and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
