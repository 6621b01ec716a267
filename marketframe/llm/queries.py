"""One query for each operator of this subpackage, over whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.llm.common import table
from marketframe.llm.conversations import audits, damage
from marketframe.llm.decontaminate import contaminated
from marketframe.llm.fingerprints import with_edits
from marketframe.llm.html_text import extract_main_text
from marketframe.llm.mixing import mix
from marketframe.llm.pii import KINDS as PII_KINDS
from marketframe.llm.pii import digest_spans, find_personal_data
from marketframe.llm.quality import CORPUS_RULES, score_quality
from marketframe.llm.reshard import reshard
from marketframe.llm.secret_scan import BASE_KINDS, find_secrets
from marketframe.llm.secret_scan import KINDS as SECRET_KINDS
from marketframe.llm.simhash import near_duplicates
from marketframe.llm.token_files import tokenise
from marketframe.llm.toxicity import score_toxicity
from marketframe.llm.whitening import whitened_embeddings


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_mixing_raked(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    return drawn.select(
        "doc_id",
        F.col("_m_source").alias("source"),
        F.col("_m_lang").alias("lang"),
        F.col("_m_topic").alias("topic"),
        F.col("_m_tokens").alias("n_tokens"),
        F.round("_m_weight", 6).alias("weight"),
        F.round("_m_rate", 6).alias("probability"),
        F.col("_m_kept").alias("kept"),
    )


def op2_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op3_secret_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    return digest_spans(found, SECRET_KINDS, BASE_KINDS)


def op4_reshard_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From eight shards by source, uneven with its hot source, to eight of equal bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    by_source = F.crc32(F.coalesce("source", F.lit("")).cast("binary")) % 8
    return reshard(docs, by_source).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        by_source.cast("int").alias("old_shard"),
    )


def op5_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), CORPUS_RULES, keep=["doc_id"])


def op6_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontaminate_latent(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contaminated(docs, benchmark).drop("text_key")


def op8_bitplane_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenise(spark, table(spark, sf_dir, "documents"), tokenizer_path())


def op9_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    return digest_spans(found, PII_KINDS, PII_KINDS)


def op10_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    classed = near_duplicates(table(spark, sf_dir, "documents"))
    hexadecimal = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return classed.select("doc_id", hexadecimal.alias("fingerprint"), "component_id")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = damage(table(spark, sf_dir, "conversations"))
    return audits(turns).withColumnRenamed("conv", "conv_id")


def op12_whitening_jacobi_davidson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_embeddings(table(spark, sf_dir, "embeddings"))


def op13_quartile_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_edits(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_mixing_raked,
        op2_html_mincut,
        op3_secret_cnn,
        op4_reshard_flow,
        op5_quality_divergence,
        op6_toxicity_ftrl,
        op7_decontaminate_latent,
        op8_bitplane_tokens,
        op9_pii_weak_supervision,
        op10_simhash_covering,
        op11_conversation_repair,
        op12_whitening_jacobi_davidson,
        op13_quartile_fingerprints,
    )
}
ORACLES: dict[str, str] = {}
