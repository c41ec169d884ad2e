"""The corpus pipeline: five stages over documents, each written as Parquet and read again.

toxicity -> exact dedup -> n-gram Jaccard join -> mixing -> packing.  Every
stage works on all rows that its predecessor kept; all but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelworks.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from parcelworks.llm.common import stored, table
from parcelworks.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches their language's threshold go."""
    model = toxicity.fit_on(docs, table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_duplicates(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a five-word shingle similarity of 0.8 or more, one stays."""
    return ngram_join.one_per_component(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, each once per epoch in which its source's budget takes it."""
    return mixing.mix(docs, marks=False)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), capacity=1024, end_id=2)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# The toxicity model is trained, so SQL cannot state the rows; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
