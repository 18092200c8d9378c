"""The corpus pipeline: toxicity, exact dedup, near duplicates, decontamination, mixing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents. All but the last
keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.llm import decontam, dedup, jaccard, mixing, toxicity
from skyledger.llm.store import save


def without_toxic(spark, docs, sf_dir):
    """Documents that the network doesn't predict toxic."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_civil(docs, model)


def without_copies(spark, docs, sf_dir):
    """Of equal texts, the one with the smallest id."""
    return dedup.keep_first_copies(docs)


def without_near_copies(spark, docs, sf_dir):
    """One document of each component of similar shingle sets."""
    return jaccard.keep_one_of_each(docs)


def without_benchmark(spark, docs, sf_dir):
    """Documents in which no benchmark item is found."""
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark, docs, sf_dir):
    """The documents that the mix takes, and how many words (repeats counted) of each."""
    return mixing.mix(docs).filter(F.col("taken") > 0)


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("n-gram jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("mixing", mixed),
]

#: A trained network and seeded sampling aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows of the last stage for the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
