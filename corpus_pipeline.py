"""A corpus pipeline out of the text operators: clean, deduplicate, pack.

Each stage takes (spark, docs, folder) and returns a DataFrame that is stored as Parquet
and read again as the next one's documents. All but the last return the columns of
``documents``; the last returns the pieces of the training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotwise.llm import exact_dedup, ngram_join, packing, suffix_dedup, toxicity
from lotwise.llm.common import table
from lotwise.llm.queries import PACKING_TOKENIZER
from lotwise.sources.scratch import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    return toxicity.drop_toxic(docs, table(spark, folder, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts, the largest id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents linked by their shingles, the smallest id stays."""
    return ngram_join.keep_first(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Long passages that occur twice go; the documents stay, be they empty then."""
    return suffix_dedup.drop_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of training sequences."""
    return packing.pack_documents(docs, PACKING_TOKENIZER, encode_special_tokens=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("suffix_dedup", drop_repeats),
    ("packing", pack),
]
# A trained classifier, component search and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the stages make of the documents in ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
