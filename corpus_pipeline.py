"""A corpus pipeline: toxicity, near-duplicates, benchmark passages, secrets, then the mix of sources.

Each stage gets all that its predecessor kept, written as Parquet and read again, and returns whole documents.
Documents are identified by doc_id; columns other than those of the table pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.llm import decontaminate, mixing, neardup, secret_scan, toxicity
from duskwatch.llm.queries import MIX_WEIGHTS, TOXIC_CHAIN
from duskwatch.session import prepare, stage

ORACLE_SQL = None  # SQL can't express the learned and hashed stages; tests/llm compares each with brute force


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go."""
    chain = toxicity.fit_chain(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), TOXIC_CHAIN)
    return toxicity.without_toxic(docs, chain)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, similarity 0.8 or more."""
    return neardup.without_near_duplicates(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share ten words in a row, or a whole shorter item, with the benchmark go."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; n_chars follows where the table has it."""
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents come as often as the mix takes them, up to three times."""
    return mixing.mix_sources(docs, mixing.cycle_weights(MIX_WEIGHTS))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
