"""From raw documents to training shards: five stages, each one operator of ``refinery.llm``.

Every stage takes the documents that the one before it kept, as written to the shared
scratch folder, and returns a DataFrame with the columns of ``documents``; the last adds
``shard`` and ``slot``. A stage decides on its own input only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from refinery.llm.common import stored, table
from refinery.llm.decontaminate import drop_contaminated
from refinery.llm.hilbert_shards import shard_documents
from refinery.llm.mixing import thin_to_targets
from refinery.llm.ngram_join import keep_one
from refinery.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below their language's threshold."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingle similarity of 0.8 or more."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that expected domain tokens approach the target shares."""
    return thin_to_targets(docs, table(spark, sf_dir, "labels"))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with shard and slot along the Hilbert curve."""
    return shard_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: The classifiers and iterations of the stages are not expressible in SQL; the tests
#: hold the stages against brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each to the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
