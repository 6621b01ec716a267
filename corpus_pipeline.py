"""From raw documents to token files, in stages that each hand a table to the next."""

from pyspark.sql import DataFrame, SparkSession

from marketframe.llm.common import spill, table
from marketframe.llm.decontaminate import decontaminate
from marketframe.llm.mixing import mixed_documents
from marketframe.llm.quality import keep_good
from marketframe.llm.queries import tokenizer_path
from marketframe.llm.simhash import one_per_group
from marketframe.llm.token_files import tokenise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokenise(spark, docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

# Fingerprints, latent retrieval and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; every stage's result is a written table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = spill(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
