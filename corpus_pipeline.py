"""From raw documents to token ids: bad texts out, copies out, near copies out, sources mixed, texts encoded.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept. `run` writes each
stage's result as Parquet below the cluster's shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lendspark.llm import bpe, exact_dedup, mixing, near_copies, quality
from lendspark.llm.common import documents, prepare, table
from lendspark.session import remove, scratch, scratch_path


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality model rejects; it learns from the labelled ones not held out.

    A null or empty text is judged as an empty one; repeated rows are judged alike; no documents, no rows. Without usable
    labels all documents have the same score, the model's base.
    """
    prepare(spark)
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts.

    Null, empty and blank texts are equal. The longest text stays, then the smallest id, null ids last; of repeated rows one.
    """
    prepare(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group whose shingles of five words have a similarity of 0.8 or more.

    Fingerprints in BK-trees find the candidates, as for op3, but at a radius for this similarity. Texts without words are
    one group. The smallest id stays, null ids last; of repeated rows one.
    """
    prepare(spark)
    return near_copies.drop_near_copies(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents until every source has its target weight.

    Texts without words are left out; a null source is a source; repeated rows and rows without an id are drawn like others.
    """
    prepare(spark)
    return mixing.mixed_rows(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digests that show they decode to it.

    A null text is an empty one, with no tokens; repeated rows and rows without an id each give a row. In all stages other
    columns go along, whatever their names; here, in the last, they are dropped.
    """
    prepare(spark)
    return bpe.round_trip(docs, *bpe.public_tokenizer(spark))


STAGES = [
    ("quality classifier", good_texts),
    ("exact dedup", first_copies),
    ("SimHash near-dedup", one_of_near_copies),
    ("source mixing", mixed_sources),
    ("byte-level BPE", encoded),
]

# The classifier and the fingerprints have no SQL form; tests/llm compares the operators with plain Python, and the run with its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = documents(spark, sf_dir), None
    for name, stage in STAGES:
        path = scratch_path(spark, "stage")
        with scratch(spark):  # what a stage stored on its way goes with it, and what it read with the next
            stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            remove(spark, last)
        docs, last = spark.read.parquet(path), path
    return docs
