"""Driver-facing queries of the operators: thin wrappers over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from refinery.llm.common import table
from refinery.llm.conversation_repair import conversation_repair
from refinery.llm.decontaminate import contaminated
from refinery.llm.fim_frames import fim_digests
from refinery.llm.hilbert_shards import hilbert_shards
from refinery.llm.html_text import main_text
from refinery.llm.licenses import scan_licenses
from refinery.llm.minhash_tensor import near_duplicates
from refinery.llm.mixing import soft_mixing
from refinery.llm.ngram_join import ngram_components
from refinery.llm.oracles import ORACLES  # noqa: F401  (read by the entry point)
from refinery.llm.quality import quality_rules
from refinery.llm.secrets import find_secrets
from refinery.llm.toxicity import toxicity
from refinery.llm.warc import warc_roundtrip


def op1_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_roundtrip(table(spark, sf_dir, "pages"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op3_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards(table(spark, sf_dir, "documents"))


def op4_conv_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_robust_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


def op8_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return soft_mixing(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op10_boosted_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op11_fim_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_digests(table(spark, sf_dir, "documents"))


def op12_minhash_tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_warc_transactions, op2_license_scan, op3_hilbert_sharding, op4_conv_toxicity, op5_benchmark_decontamination,
        op6_robust_quality, op7_ngram_jaccard_join, op8_soft_mixing,
        op9_entropy_secrets, op10_boosted_html_text, op11_fim_frames, op12_minhash_tensor,
        op13_conversation_repair)
}
