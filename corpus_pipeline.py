"""From raw documents to token-id files: each stage works on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.llm import language, mixing, simhash
from marketbars.llm.common import free_names
from marketbars.llm.decontamination import without_leaks
from marketbars.llm.queries import FILE_END, table, tokenizer
from marketbars.llm.tokenfile import token_files
from marketbars.session import work_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any letter in a script of a learned language are in none, and go."""
    return language.known_language(docs, learned_scripts=True)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which the sources meet their target weights."""
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files in the order of the stored rows: what was written, read back.

    Rows that do not come from Parquet files have no such order; they go by doc_id.
    """
    if not docs.inputFiles():
        return token_files(docs, tokenizer(), FILE_END)
    part, row = free_names(docs, "part", "row")
    number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("bigint")
    placed = docs.withColumns({part: number, row: F.col("_metadata.row_index")})
    return token_files(placed, tokenizer(), FILE_END, order=(part, row))


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

# Models, hashes and tokenizers: SQL expresses no stage but by calling them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = work_dir(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
