"""From raw documents to packed training sequences, one operator a stage.

Every stage takes the documents that its predecessor kept, read from the table it
wrote, and returns the columns of documents; the last returns sequences.

Defined results, for all stages: a null text is an empty one and stays null; rows of a null
or shared id are rows of their own; further columns, whatever their names, pass through
to the last stage, which doesn't read them; an empty table gives no rows. Without labels
of both kinds no document is toxic. Null and empty texts are copies of each other, so one
row of them is kept; no text is, when the mix takes documents, as it has no words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorspan.llm import crf, feistel, minhash, mixing, packing
from mirrorspan.llm.common import materialized, table
from mirrorspan.llm.queries import PSEUDONYM_KEY


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the tagger scores as toxic."""
    model = crf.train(*crf.training_sample(docs, table(spark, sf_dir, "labels")))
    return crf.clean(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one of the smallest id, of every class."""
    return minhash.distinct(docs)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal values in the texts."""
    return feistel.replaced(docs, PSEUDONYM_KEY)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents as the mix of the sources says."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of whole documents and, of long ones, pieces, with their texts."""
    return packing.pack(docs, texts=True)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("pseudonyms", pseudonyms),
    ("mixing", mix),
    ("packing", pack),
]
# A trained tagger and hashed sketches are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialized(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
