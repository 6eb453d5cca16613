"""From raw documents to packed sequences: the stages, in order, and a run of all.

Each stage takes the documents its predecessor kept and returns documents, the last one
packed pieces with their token ids. Between stages documents are written and read again.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm import decontamination, near_duplicates, packing, quality_gam, secrets
from txrisk.llm.tables import read
from txrisk.sources.stages import materialize


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from ``labels``."""
    return quality_gam.keep_accepted(docs, read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_duplicates.drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of ``benchmark``."""
    return decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with marks in place of secrets."""
    clean = secrets.redact_secrets(docs)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.length("text").cast(kind))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as sequences of power-of-two lengths, with their token ids."""
    return packing.pack_binary(docs, with_ids=True)


STAGES = [
    ("quality_classifier", keep_good),
    ("near_duplicates", drop_near_copies),
    ("decontamination", decontaminate),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]

# Trained scores and library tokens are not for SQL to express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
