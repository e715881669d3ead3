"""SpotSigs fingerprints: chains of content words that follow common words.

Wherever an anchor stands, a signature is made of the anchor and the next
``CHAIN`` content words, ``DISTANCE`` apart. Anchors are the common words of a few
languages; so that texts in others, lists and tables are spotted too, every eighth
content word by hash is an anchor as well. A text's fingerprint is the set of its
signatures, written in base64 as sorted 32-bit numbers; a text too short for any
signature has the one of its whole text instead. Likeness is the Jaccard
coefficient of two sets.

``edited`` meets each text with its successor: the documents are dealt by ranges of
their order, and the first document of each range is dealt to the range before it
too, so one shuffle of the texts is enough. ``similar`` finds all pairs of a given
likeness: sets are partitioned by length, only neighbouring partitions meet, and
only where they share one of their rarest signatures.

Defined results: a null text is an empty one; two empty texts are alike (1.0), an
empty and any other are not; documents follow each other by id (null first; equal
ids by a hash of the text), the last one by the first, so a single document is its
own successor; repeated rows each have a result; an empty table gives no rows; only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirrorspan.llm.common import materialized

CHAIN = 3
DISTANCE = 1
SAMPLED = 8
BATCH_CHARS = 3_000_000
# Scripts without blanks are read letter by letter.
WORDS = re.compile(r"[぀-ヿ㐀-鿿]|[^\W_]+")

# Common words of English, German, French and Spanish.
COMMON = frozenset(
    "a an and are as at be been but by for from had has have he her his i in is it its not of "
    "on or she that the their there they this to was we were which will with you "
    "aber auch auf aus bei das dem den der des die durch ein eine einem einen einer es für hat "
    "ich im ist man mit nach nicht noch oder sich sie sind so um und vom von war wie wird zu zum "
    "zur au aux avec ce ces cette dans de du elle en est et eux il je la le les leur lui mais ne "
    "nous ou par pas plus pour qu que qui sa se ses son sur un une vous "
    "al como con del el ella ellos era es esta este fue ha hay las lo los más me mi muy no o para "
    "pero por se si sin sobre su sus también te tu uno una y ya".split()
)

_MIX = np.array(
    [0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64
)


class _Words(dict):
    """Numbers words, with their hash and whether they are common, in order of arrival."""

    def __init__(self):
        self.hashes: list[int] = []
        self.common: list[bool] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self.hashes)
        self.hashes.append(zlib.crc32(word.encode("utf-8", "replace")))
        self.common.append(word in COMMON)
        return number


class Spotter:
    """Signature sets of batches of texts, remembering the words it has met."""

    MOST = 400_000

    def __init__(self):
        self.words = _Words()

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        """The sorted signatures of every text."""
        if len(self.words) > self.MOST:
            self.words = _Words()
        docs = [WORDS.findall(t.lower()) for t in texts]
        sizes = np.fromiter(map(len, docs), np.int64, len(docs))
        flat = np.fromiter(
            map(self.words.__getitem__, itertools.chain.from_iterable(docs)),
            np.int64, int(sizes.sum()),
        )
        owner = np.repeat(np.arange(len(docs)), sizes)
        hashes = np.array(self.words.hashes, np.uint64)[flat] if len(flat) else flat.astype("u8")
        common = np.array(self.words.common, bool)[flat] if len(flat) else flat.astype(bool)
        content = np.flatnonzero(~common)
        anchors = np.flatnonzero(common | (hashes % SAMPLED == 0))
        # The first content word after each anchor, then every DISTANCE-th.
        after = np.searchsorted(content, anchors, side="right")
        far = after + (CHAIN - 1) * DISTANCE
        kept = far < len(content)
        kept[kept] = owner[content[far[kept]]] == owner[anchors[kept]]
        anchors, after = anchors[kept], after[kept]
        value = _scramble(hashes[anchors])
        for k in range(CHAIN):
            value = _scramble(value ^ hashes[content[after + k * DISTANCE]] * _MIX[0])
        # Sorted and distinct within each text.
        key = np.unique(owner[anchors].astype(np.uint64) << np.uint64(32) | value >> np.uint64(32))
        cuts = np.searchsorted(key, np.arange(1, len(docs), dtype=np.uint64) << np.uint64(32))
        found = np.split((key & np.uint64(0xFFFFFFFF)).astype("<u4"), cuts)
        return [
            own if len(own) else np.array([zlib.crc32(t.encode("utf-8", "replace"))], "<u4")
            for own, t in zip(found, texts)
        ]


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * _MIX[1]
    x = (x ^ x >> np.uint64(27)) * _MIX[2]
    return x ^ x >> np.uint64(31)


def written(signatures: np.ndarray) -> str:
    return base64.b64encode(signatures.tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard coefficient of two sorted sets, neither empty."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def edit(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by the first as many characters of the next."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _key() -> Column:
    """The order of the documents; a null id comes first."""
    known = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    return F.struct(known.alias("id"), F.xxhash64("text").alias("hash"))


def _bucket(key: Column, bounds: Column, n: int) -> Column:
    """Number of bounds up to ``key``, less one, by binary search."""
    steps = [1 << k for k in reversed(range(n.bit_length()))]
    found = F.lit(0)
    return F.aggregate(
        F.array(*map(F.lit, steps)),
        found,
        lambda at, step: F.when(
            (at + step <= n) & (F.get(bounds, at + step - 1) <= key), at + step
        ).otherwise(at),
    ) - 1


def _dealt(texts: DataFrame, bounds: list) -> DataFrame:
    """Each row in the partition of its range, and the first of a range also, as halo,
    in the partition before it."""
    n = len(bounds)
    # One text, which the optimizer turns into one literal however many ranges there are.
    known = json.dumps([{"id": b["id"], "hash": b["hash"]} for b in bounds])
    first = F.from_json(F.lit(known), "array<struct<id:bigint,hash:bigint>>")
    here = F.struct("bucket", F.lit(False).alias("halo"))
    before = F.struct(
        ((F.col("bucket") + n - 1) % n).alias("bucket"), F.lit(True).alias("halo")
    )
    opens = F.get("bounds", F.col("bucket")) == F.col("key")
    return (
        texts.withColumn("key", _key())
        .withColumn("bounds", first)
        .withColumn("bucket", _bucket(F.col("key"), F.col("bounds"), n))
        .withColumn("places", F.when(opens, F.array(here, before)).otherwise(F.array(here)))
        .select("doc_id", "text", "key", F.explode("places").alias("place"))
        .select("doc_id", "text", "key", "place.*")
        .repartitionById(n, F.col("bucket"))
    )


def edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and edited texts, with their likeness."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keys = texts.select(_key().alias("key"))
    ranges = keys.repartitionByRange(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "key"
    ).groupBy(F.spark_partition_id().alias("part"))
    # One key for each partition.
    bounds = sorted(r["first"] for r in ranges.agg(F.min("key").alias("first")).collect())
    if bounds:
        texts = _dealt(texts, bounds)
    else:  # no rows at all
        texts = texts.select("*", _key().alias("key"), F.lit(0).alias("bucket"), F.lit(False).alias("halo"))
    rows = texts.sortWithinPartitions("bucket", "halo", "key", "text").select(
        "doc_id", "text", "halo"
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(
        _compare,
        f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )


def _compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order, the successor of the last one marked as halo."""
    spotter = Spotter()
    waiting: tuple | None = None
    for frame in frames:
        ends = np.cumsum(frame["text"].str.len().to_numpy(np.int64)) // BATCH_CHARS
        for _, some in frame.groupby(ends, sort=False):
            ids, texts = some["doc_id"].tolist(), some["text"].tolist()
            halo = some["halo"].tolist()
            sets = spotter.sets(texts)
            if waiting is not None:
                ids, texts = [waiting[0], *ids], [waiting[1], *texts]
                sets, halo = [waiting[2], *sets], [False, *halo]
            # Rows that open a range may repeat; any of their halo rows will do.
            own = [k for k in range(len(ids) - 1) if not halo[k]]
            if not halo[-1]:
                waiting = ids[-1], texts[-1], sets[-1]
            else:
                waiting = None
            if own:
                yield _results(spotter, ids, texts, sets, own)
    assert waiting is None, "the last row of a partition has no successor"


def _results(spotter: Spotter, ids, texts, sets, own: list[int]) -> pd.DataFrame:
    changed = [edit(texts[k], texts[k + 1]) for k in own]
    changed_sets = spotter.sets(changed)
    out = pd.DataFrame({
        "doc_id": pd.Series([ids[k] for k in own], dtype="object"),
        "n_chars": [len(texts[k]) for k in own],
        "edited_sha256": [
            hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed
        ],
        "fingerprint": [written(sets[k]) for k in own],
        "edited_fingerprint": [written(s) for s in changed_sets],
        "near_edited": [likeness(sets[k], s) for k, s in zip(own, changed_sets)],
        "near_next": [likeness(sets[k], sets[k + 1]) for k in own],
    })
    out["doc_id"] = [None if pd.isna(i) else int(i) for i in out["doc_id"]]
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, signatures) of every row; signatures are sorted and distinct."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spotter = Spotter()
        for frame in frames:
            ends = np.cumsum(frame["text"].str.len().to_numpy(np.int64)) // BATCH_CHARS
            for _, some in frame.groupby(ends, sort=False):
                sets = spotter.sets(some["text"].tolist())
                yield pd.DataFrame({
                    "doc_id": some["doc_id"].to_numpy(),
                    "signatures": [s.astype(np.int64) for s in sets],
                })

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {id_type}, signatures array<long>")


def similar(prints: DataFrame, least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): the class of every document, and all pairs of classes whose sets
    have a Jaccard coefficient of ``least`` or more.

    A class is a distinct set, with a number of its own (``node``); ids only name it: the
    smallest one of its documents is ``class_id``, null if none has any. Classes may share
    a name where documents share an id.
    """
    shared = prints.groupBy("signatures").agg(F.min("doc_id").alias("class_id"))
    sets = materialized(
        shared.select(
            F.monotonically_increasing_id().alias("node"), "class_id", "signatures",
            F.size("signatures").alias("n"),
        ),
        "spots-sets",
    )
    members = prints.join(sets.drop("n"), "signatures").select("doc_id", "class_id", "node")
    each = sets.select("node", "n", F.explode("signatures").alias("signature"))
    common = each.groupBy("signature").agg(F.count("*").alias("sets"))
    rarest = Window.partitionBy("node").orderBy("sets", "signature")
    # Two sets that are alike share one of these, in the order of rarity.
    needed = F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1
    heads = (
        each.join(common, "signature")
        .withColumn("place", F.row_number().over(rarest))
        .filter(F.col("place") <= needed)
        # Lengths of one partition differ by less than the likeness allows.
        .withColumn("part", F.floor(F.log(F.col("n")) / F.log(F.lit(1 / least)) + 1e-9))
        .select("node", "n", "signature", "part")
    )
    heads = materialized(heads, "spots-heads")
    left = heads.withColumn("part", F.explode(F.array(F.col("part"), F.col("part") + 1)))
    right = heads.select(
        F.col("node").alias("other_node"), F.col("n").alias("other_n"), "signature", "part"
    )
    met = (
        left.join(right, ["signature", "part"])
        .filter("node != other_node and n <= other_n")
        .filter((F.col("n") < F.col("other_n")) | (F.col("node") < F.col("other_node")))
        .filter(F.col("n") >= F.col("other_n") * least - 1e-9)
        .select("node", "other_node")
        .distinct()
    )
    named = sets.select("node", "class_id", "signatures")
    other = named.toDF("other_node", "other_id", "other_signatures")
    both = met.join(named, "node").join(other, "other_node")
    overlap = F.size(F.array_intersect("signatures", "other_signatures"))
    value = overlap / (F.size("signatures") + F.size("other_signatures") - overlap)
    # The smaller name first, null before all; equal names by the number.
    ends = F.array_sort(F.array(
        F.struct(F.coalesce("class_id", F.lit(-(2**63))).alias("key"), "node", "class_id"),
        F.struct(F.coalesce("other_id", F.lit(-(2**63))).alias("key"), F.col("other_node").alias("node"),
                 F.col("other_id").alias("class_id")),
    ))
    pairs = both.filter(value >= least).select(ends.alias("ends"), value.alias("likeness")).select(
        F.col("ends")[0]["class_id"].alias("class_id"), F.col("ends")[1]["class_id"].alias("other_id"),
        "likeness",
        F.col("ends")[0]["node"].alias("node"), F.col("ends")[1]["node"].alias("other_node"),
    )
    return members, pairs
