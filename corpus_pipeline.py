"""Text documents to packed training sequences: toxicity, near duplicates, source mix, packing.

Each stage is (spark, docs, sf_dir) -> DataFrame and works on all that its predecessor kept; all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from seqloom.llm import crf_toxicity, mixing, shingle_copies, simhash_segments, swap_packing
from seqloom.llm.common import shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger, trained on the labelled ones among them, does not reject.

    Null, empty and blank texts have no toxic words and are judged by the score of no evidence; rows
    without doc_id, repeated rows and all columns stay as they are; without labels nothing is rejected.
    """
    return crf_toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id.

    Near copies are texts whose five-word shingles have a Jaccard similarity of 0.8 or more. SimHash
    fingerprints and their segment popcounts propose the first links; as most pairs at that
    similarity differ in more bits than a fingerprint can be searched for, shared rare shingles propose the
    rest. All links are verified exactly.

    Null, empty and blank texts are copies of each other; rows that repeat a doc_id are one document,
    of which one row stays; rows without doc_id stay.
    """
    return simhash_segments.keep_one(docs, shingle_copies.near_copies)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's weight asks for.

    A null source is a source; null and empty texts have size 0 and follow their source's rate, which
    is 0 if all its texts are empty; rows that repeat a doc_id draw alike, as do rows without one.
    """
    return mixing.emit(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mixed documents and their places in sequences.

    Null and empty texts are the end id alone; copies and rows that repeat a doc_id are packed each.
    """
    return swap_packing.packed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: A trained tagger and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet to the shared folder and read again.

    An empty table goes through as one.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
