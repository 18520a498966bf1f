"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept; what it returns
is written and read again as the next one's documents.

Empty tables go through all stages. Null and empty texts are kept by the filters, weigh nothing in the
mix, and are one end token each where their source has words to give. Repeated rows stay repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchline.llm import mixing, near_duplicates, packing, repeats, toxicity
from touchline.llm.common import table
from touchline.llm.shipping import with_package
from touchline.session import materialise


@with_package
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, trained on the labelled ones, doesn't call toxic."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


@with_package
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of every group of near-duplicates (80 of 100 shingles)."""
    return near_duplicates.without_near_duplicates(docs)


@with_package
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that a document with a smaller doc_id has too."""
    return repeats.without_repeats(docs)


@with_package
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: up to three times, or not at all."""
    return mixing.mix(docs)


@with_package
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2,048 tokens."""
    return packing.pack_documents(docs).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# A trained classifier and a tokenizer aren't SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents in ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
