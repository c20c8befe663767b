"""The corpus pipeline: five stages, each over all that the stage before it kept.

Toxic documents go, then all but one of each group of near duplicates (five-word shingles, a
similarity of 0.8 or more), then documents that hold a benchmark item; live-looking secrets are
masked, and what is left is packed into sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm.op02_secrets import redact
from farelane.llm.op04_packing import pack
from farelane.llm.op05_decontamination import without_leaks
from farelane.llm.op06_toxicity import without_toxic
from farelane.llm.op07_jaccard_join import one_of_each
from farelane.llm.ship import ship
from farelane.session import save_table


#: Rows that a Python worker is sent at once, in all stages; long texts make larger batches heavy.
BATCH_ROWS = 1000


BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the library sent to its workers and small Arrow batches. A stage's rows are
    computed when its caller writes them, so the setting stays; ``run`` puts it back at the end."""
    spark.conf.set(BATCHES, str(BATCH_ROWS))
    return ship(spark)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects."""
    prepared(spark)
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each group of near duplicates."""
    prepared(spark)
    return one_of_each(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold an item of the benchmark, re-parameterised or not."""
    prepared(spark)
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With live-looking secrets masked; every document stays, and ``n_chars`` follows its text."""
    prepared(spark)
    masked = redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.length("text").cast(kind))
    return masked


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place in it."""
    prepared(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: SQL can't express the classifier or the packing. tests/llm compares near duplicates with brute force
#: as a stage, and the operators of the other stages: leaks with a matcher of words, secrets' spans
#: with patterns, the classifier's update with a plain one and its labels held out, packing with bins.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = spark.conf.get(BATCHES)
    try:
        for name, stage in STAGES:
            docs = save_table(stage(spark, docs, sf_dir), f"stage-{name}")
    finally:
        spark.conf.set(BATCHES, given)
    return docs
