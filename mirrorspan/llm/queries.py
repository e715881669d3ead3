"""One query per operator of this package, over whole tables.

An operator that SQL can express has its DuckDB SQL in ``oracles``; the others
are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorspan.llm import (
    bitpack,
    bpe,
    collocations,
    crf,
    dualtree,
    feistel,
    fm,
    licenses,
    minhash,
    mixing,
    packing,
    runs,
    spotsigs,
)
from mirrorspan.llm.common import table
from mirrorspan.llm.oracles import ORACLES
from mirrorspan.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

__all__ = ["ORACLES", "QUERIES"]


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# Stands in for the secret that a deployment passes.
PSEUDONYM_KEY = b"mirrorspan pseudonyms"

TOKENIZER = "word_bpe_49k.json"
VOCABULARY = 49_408
END_ID = 1
RANKS = "byte_bpe_multi_50k.tiktoken"


@_query
def op3_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids as read back from the bit-packed shards."""
    import public_tokenizers

    out = scratch_dir(spark, "token-ids")
    shards = bitpack.write_shards(
        table(spark, folder, "documents"), out, str(public_tokenizers.path(TOKENIZER)),
        END_ID, VOCABULARY,
    )
    return bitpack.read_shards(shards, out)


@_query
def op9_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Words the mix takes of every document."""
    return mixing.mix(table(spark, folder, "documents"), keep=("doc_id",)).select(
        F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", "taken"
    )


@_query
def op10_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 512 to 4,096 words."""
    return packing.pack(table(spark, folder, "documents"))


@_query
def op7_toxic_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, with the number of its toxic spans."""
    docs = table(spark, folder, "documents")
    model = crf.train(*crf.training_sample(docs, table(spark, folder, "labels")))
    return crf.score(docs, model).withColumn("n_spans", F.size("spans"))


@_query
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    return licenses.summary(licenses.scan(table(spark, folder, "documents")))


@_query
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document."""
    docs = table(spark, folder, "documents")
    return fm.score(docs, fm.train(*fm.training_sample(docs, table(spark, folder, "labels"))))


@_query
def op6_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its personal values replaced by linked pseudonyms."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return feistel.pseudonymised(docs, PSEUDONYM_KEY).select(
        F.col("doc.doc_id").alias("doc_id"), "text", "n_numbers", "n_dates", "n_others"
    )


@_query
def op1_spot_signatures(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every text and its edited text."""
    return spotsigs.edited(table(spark, folder, "documents"))


@_query
def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return minhash.near_duplicates(table(spark, folder, "documents"))


@_query
def op4_dual_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The five vectors nearest to each query by inner product."""
    return dualtree.top_k(table(spark, folder, "embeddings"))


@_query
def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids by the ranks, and what they decode to, as digests."""
    import public_tokenizers

    ranks = str(public_tokenizers.path(RANKS))
    return bpe.digests(bpe.decode(bpe.encode(table(spark, folder, "documents"), ranks), ranks))


@_query
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The phrases of each language that hold together best."""
    return collocations.collocations(table(spark, folder, "documents"))


@_query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of every text; one in ten is given a repeated tail first."""
    return runs.digests(runs.find(table(spark, folder, "documents"), runs.repeated_tail))
