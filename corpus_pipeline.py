"""From raw documents to packed sequences: what to leave out, what to mask, how to lay out the rest.

Each stage works on all rows its predecessor kept and returns the columns of ``documents``; the last
one returns the pieces and their places.  Stages are stored as Parquet in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickerloom.llm import decontaminate, jaccard, packing, secrets, toxicity
from tickerloom.llm.shared import documents, lean, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models call toxic go."""
    lean(spark)
    return toxicity.without_toxic(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies (five words, 0.8) the document with the least id stays."""
    lean(spark)
    return jaccard.one_per_class(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    lean(spark)
    return decontaminate.without_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; no document goes."""
    lean(spark)
    return secrets.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents left, in sequences of 2048 ids."""
    lean(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", one_of_near_copies),
    ("decontamination", drop_benchmark),
    ("secrets", mask_secrets),
    ("packing", pack),
]

# The stages score, align and tokenise: SQL cannot express them; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
