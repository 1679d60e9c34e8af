"""Training-data pipeline: from raw documents to token ids, in five stages.

Each stage reads all that the one before it kept, as a table in the shared folder, so a lost
executor costs a stage's tasks and never an earlier stage. Texts emptied by a stage stay as
documents without text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cartlane.llm import bpe, decontaminate, jaccard, lines, toxicity
from cartlane.llm.shared import kept, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at or above the toxicity threshold of their language go.

    The model and the thresholds come from all labelled documents but those that are held out to judge it.
    """
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), crossed=True)
    return toxicity.clean_documents(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in three documents or more stay in the one with the largest id only."""
    return lines.drop_repeated_lines(docs, length="n_chars")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays: the one with the smallest id.

    Similar are 0.8 of the shingles of five words; the query ``op7_ngram_join`` has its own numbers.
    """
    return jaccard.one_of_each(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens, digest of the ids, and digest of the text decoded from them."""
    return bpe.token_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", encode),
]

# A trained classifier has no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over all documents."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
