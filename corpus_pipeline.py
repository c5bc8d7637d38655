"""The corpus pipeline: five stages from raw documents to token files, each an operator of ``aeroband.llm``.

Each stage takes all that the stage before it kept; its result is written to the shared folder and read again, which
cuts the lineage and survives lost executors. All but the last return the columns of ``documents``.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aeroband.llm import decontamination, mixing, quality_rules, queries, simhash_dedup, token_files
from aeroband.session import scratch_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.keep_one_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_contaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    folder = f"{scratch_folder(spark)}/tokens"
    token_files.write_tokens(docs, folder, queries.tokenizer_path())
    return token_files.read_checksums(spark, folder)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination_stage),
    ("mixing", mix),
    ("token_files", tokens),
]

# Fingerprints, pseudorandom mixing and a tokenizer are beyond SQL; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = f"{scratch_folder(spark)}/stage"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
