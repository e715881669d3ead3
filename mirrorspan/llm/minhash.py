"""Near-duplicates by Order MinHash, verified by banded alignment.

A text's k-mers are its runs of five words, each labelled with its occurrence, so
that a repeated one counts as often as it stands there. For each of ``BANDS`` hash
functions the sketch takes the ``TAKEN`` least k-mers and keeps them in the order
of the text; their hash is the key of a band. Texts that share a key are
candidates. A sketch also holds one bit of the least k-mer under ``BITS``
functions, whose distance bounds the overlap well enough to drop hopeless
candidates before their texts are fetched.

A band takes too large a part of a short text to be found by chance, so pairs with a
text of ``SHORT`` k-mers or fewer have an exact way: as many insertions and deletions
as the limit allows leave one of so many parts and one of the shorter text whole.
Every part is a key, and so is every run of the longer text that can be one; such
pairs are not filtered by bits.

Two texts are linked if the k-mers that an alignment matches in order are
``LEAST`` or more of all their k-mers; only alignments that can reach it, a band
around the diagonal, are explored. A class is a connected component of links and
is named after its smallest id, before null.

Work within a key does not grow with the square of its texts: equal texts are one
text; every text is compared with ``LEADERS`` texts of the key; what is already in
one class needs no comparison; only texts of a key that are then still in different
classes are compared with each other, all of them.

Defined results: texts are compared by their lower-case words; null and empty texts
and texts without words are equal to each other and to nothing else; texts of fewer
than five words have one k-mer; an empty table gives no rows; only ``doc_id`` and
``text`` are read. Ids only name: the search goes over distinct texts, whatever ids
their rows have. A class without any id is named null, and classes whose smallest
id is the same one have one name; ``distinct`` still keeps a row of each.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorspan.llm.common import materialized

K = 5
LEAST = 0.8
BANDS = 20
TAKEN = 5
# Texts of so many k-mers or fewer have exact keys besides.
SHORT = 12
BITS = 256
# Differing bits at most: the mean at LEAST similarity and 3.6 deviations.
MOST_APART = 43
# Hash values held at once for a text.
HELD = 2_000_000
LEADERS = 3
# Keys of more texts than HOT are compared in blocks.
HOT = 16
BLOCK = 512
BATCH_CHARS = 2_000_000
BIT_COLUMNS = [f"bits{k + 1}" for k in range(BITS // 64)]

WORDS = re.compile(r"\w+")
_RANDOM = np.random.default_rng(20240229)
FACTORS = (_RANDOM.integers(0, 2**63, BITS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
OFFSETS = _RANDOM.integers(0, 2**63, BITS, dtype=np.uint64)
_ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * _ODD[1]
    x = (x ^ x >> np.uint64(27)) * _ODD[2]
    return x ^ x >> np.uint64(31)


def kmers(words: np.ndarray) -> np.ndarray:
    """64-bit k-mers of 32-bit word hashes, in order of the text."""
    if not len(words):
        return np.zeros(0, np.uint64)
    words = words.astype(np.uint64)
    k = min(K, len(words))
    value = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        value = _scramble(value * _ODD[0] + words[i : len(words) - k + 1 + i] + np.uint64(1))
    return value


def labelled(values: np.ndarray) -> np.ndarray:
    """The k-mers with their occurrence in the text, distinct."""
    order = np.argsort(values, kind="stable")
    own = values[order]
    first = np.ones(len(own), bool)
    first[1:] = own[1:] != own[:-1]
    if first.all():
        return _scramble(values)
    at = np.arange(len(own))
    occurrence = np.empty(len(own), np.uint64)
    occurrence[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return _scramble(values + occurrence * _ODD[0])


def sketch(words: np.ndarray) -> tuple[list[int], list[int]]:
    """(keys of the bands, bits as numbers of 64 each)."""
    labels = labelled(kmers(words))
    if not len(labels):
        return [], [0] * (BITS // 64)
    taken = min(TAKEN, len(labels))
    least, chosen = np.empty(BITS, np.uint64), np.empty((BANDS, taken), np.int64)
    each = max(1, HELD // len(labels))
    for low in range(0, BITS, each):
        high = min(low + each, BITS)
        table = labels[None, :] * FACTORS[low:high, None] + OFFSETS[low:high, None]
        least[low:high] = table.min(axis=1)
        if low < BANDS:
            own = np.argpartition(table[: BANDS - low], taken - 1, axis=1)[:, :taken]
            chosen[low : low + len(own)] = own
    bits = (least >> np.uint64(33) & np.uint64(1)).astype(np.uint8)
    numbers = np.packbits(bits).view(">u8").astype(np.uint64).view(np.int64)
    ordered = labels[np.sort(chosen, axis=1)]
    key = _scramble(np.arange(BANDS, dtype=np.uint64) + np.uint64(1))
    for k in range(taken):
        key = _scramble(key * _ODD[0] + ordered[:, k])
    return key.view(np.int64).tolist(), numbers.tolist()


def _most(n: int, m: int, least: float = LEAST) -> int:
    """Insertions and deletions between texts of n and m k-mers, at most."""
    return int((n + m) * (1 - least) / (1 + least) + 1e-9)


def _runs(n: int) -> set[tuple[int, int, int, int, int]]:
    """(shorter, longer, part, begin, end) of the runs that are keys of a text of n k-mers.

    With at most ``most`` insertions and deletions one of ``most + 1`` parts of the
    shorter text is a run of the longer one, moved by those before it.
    """
    runs = set()
    for short in range(1, min(n, SHORT) + 1):
        for long in range(short, n + 1) if short < n else range(n, 2 * n + 1):
            if n not in (short, long):
                continue
            most = _most(short, long) - (_most(short, long) - (long - short)) % 2
            if most < max(1, long - short):
                continue  # too different, or equal
            fewer, more = (most - (long - short)) // 2, (most + long - short) // 2
            moves = range(-fewer, more + 1) if n == long else range(1)
            for part in range(most + 1):
                begin, end = (short * k // (most + 1) for k in (part, part + 1))
                runs |= {
                    (short, long, part, begin + by, end + by)
                    for by in moves if 0 <= begin + by and end + by <= n
                }
    return runs


RUNS = {n: sorted(_runs(n)) for n in range(1, 2 * SHORT + 1)}


def short_keys(values: np.ndarray) -> list[int]:
    """Keys of which texts that align share one, if either has ``SHORT`` k-mers or fewer."""
    keys = {
        blake2b(bytes(sizes) + values[begin:end].tobytes(), digest_size=8).digest()
        for *sizes, begin, end in RUNS.get(len(values), ())
    }
    return [int.from_bytes(key, "little", signed=True) for key in sorted(keys)]


def aligned(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> bool:
    """Whether an alignment in order matches ``least`` of all k-mers of both."""
    n, m = len(a), len(b)
    if not n or not m:
        return n == m
    # n + m - 2 * matches, at most; it is also the width of the band.
    most = _most(n, m, least)
    if abs(n - m) > most:
        return False
    shared = len(np.intersect1d(labelled(a), labelled(b), assume_unique=True))
    if n + m - 2 * shared > most:
        return False
    # Equal ends match in some best alignment.
    size = min(n, m)
    differ = np.flatnonzero(a[:size] != b[:size])
    head = int(differ[0]) if len(differ) else size
    a, b = a[head:], b[head:]
    size = min(len(a), len(b))
    if not size:
        return True
    differ = np.flatnonzero(a[::-1][:size] != b[::-1][:size])
    tail = int(differ[0]) if len(differ) else size
    return _distance(a[: len(a) - tail].tolist(), b[: len(b) - tail].tolist(), most) is not None


def _distance(a: list[int], b: list[int], most: int) -> int | None:
    """Insertions and deletions from ``a`` to ``b`` if ``most`` suffice.

    Furthest points on the diagonals of a band, one more difference at a time.
    """
    n, m = len(a), len(b)
    furthest = {0: -1, 2: -1, 1: 0}  # diagonal x - y: largest x
    for d in range(most + 1):
        reached = {}
        for k in range(-d, d + 1, 2):
            x = max(furthest.get(k + 1, -1), furthest.get(k - 1, -2) + 1)
            y = x - k
            if x > n or y > m or x < 0 or y < 0:
                continue
            while x < n and y < m and a[x] == b[y]:
                x += 1
                y += 1
            if x == n and y == m:
                return d
            reached[k] = x
        furthest = reached
    return None


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        self[word] = h = zlib.crc32(word.encode("utf-8", "replace"))
        return h


class Hasher:
    """32-bit hashes of the words of texts."""

    MOST = 400_000

    def __init__(self):
        self.known = _Hashes()

    def words(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > self.MOST:
            self.known.clear()
        docs = [WORDS.findall(t.lower()) for t in texts]
        flat = np.fromiter(
            map(self.known.__getitem__, itertools.chain.from_iterable(docs)), np.uint32
        )
        return np.split(flat, np.cumsum([len(d) for d in docs])[:-1])


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        ends = np.cumsum(frame["text"].str.len().to_numpy(np.int64)) // BATCH_CHARS
        for _, some in frame.groupby(ends, sort=False):
            yield some


def _row() -> Column:
    """What tells rows apart: their id and text."""
    id_ = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("-"))
    return F.unhex(F.md5(F.concat_ws(" ", id_, F.coalesce("text", F.lit("")))))


def _identified(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.isNull().alias("unnamed"),
        F.coalesce(doc_id, F.lit(0)).alias("doc_id"),
        _row().alias("row"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def sketches(docs: DataFrame) -> DataFrame:
    """(unnamed, doc_id, row, same1, same2, n, keys, bits1 to bits4); equal texts have equal ``same``."""
    own = ["unnamed", "doc_id", "row"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for some in _batches(frames):
            rows = []
            for words in hasher.words(some["text"].tolist()):
                same = np.frombuffer(blake2b(words.tobytes(), digest_size=16).digest(), np.int64)
                keys, bits = sketch(words)
                n = max(len(words) - K + 1, min(1, len(words)))
                rows.append((*same, n, keys + short_keys(kmers(words)), *bits))
            drawn = pd.DataFrame(rows, columns=["same1", "same2", "n", "keys", *BIT_COLUMNS])
            yield pd.concat([some[own].reset_index(drop=True), drawn], axis=1)

    return _identified(docs).mapInPandas(
        run,
        "unnamed boolean, doc_id long, row binary, same1 long, same2 long, n int, "
        "keys array<long>, " + ", ".join(f"{c} long" for c in BIT_COLUMNS),
    )


def _may_be_alike() -> Column:
    """By length and by the bits of both sketches."""
    apart = sum(F.bit_count(F.col(c).bitwiseXOR(F.col(f"other_{c}"))) for c in BIT_COLUMNS)
    short, long = F.least("n", "other_n"), F.greatest("n", "other_n")
    return ((apart <= MOST_APART) | (short <= SHORT)) & (short >= long * LEAST - 1e-9)


def _other(bands: DataFrame) -> DataFrame:
    return bands.select("key", *(F.col(c).alias(f"other_{c}") for c in bands.columns if c != "key"))


def _verify(pairs: DataFrame, content: DataFrame) -> DataFrame:
    """The (id, other_id) of ``pairs`` that align."""
    both = pairs.join(content, "id").join(
        content.select(F.col("id").alias("other_id"), F.col("words").alias("other_words")),
        "other_id",
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            kept = [
                aligned(kmers(np.frombuffer(a, np.uint32)), kmers(np.frombuffer(b, np.uint32)))
                for a, b in zip(frame["words"], frame["other_words"])
            ]
            yield frame.loc[np.array(kept, bool), ["id", "other_id"]]

    return both.select("id", "other_id", "words", "other_words").mapInPandas(
        run, "id long, other_id long"
    )


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(id, class_id) of every id in ``links`` (id, other_id); the smallest id names it.

    Every round each node takes the smallest class around it, and then that class's
    own class; so a chain halves each round.
    """
    both = links.select("id", "other_id").unionByName(
        links.select(F.col("other_id").alias("id"), F.col("id").alias("other_id"))
    )
    both = materialized(both.distinct(), f"{label}-links")
    classes = materialized(
        both.groupBy("id").agg(F.least("id", F.min("other_id")).alias("class_id")), f"{label}-0"
    )
    for turn in itertools.count(1):
        around = (
            both.join(classes.withColumnRenamed("id", "other_id"), "other_id")
            .groupBy("id")
            .agg(F.min("class_id").alias("near"))
        )
        better = classes.join(around, "id").select(
            "id", F.col("class_id").alias("before"), F.least("class_id", "near").alias("class_id")
        )
        better = materialized(better, f"{label}-{turn}-near")
        target = better.select(F.col("id").alias("class_id"), F.col("class_id").alias("further"))
        jumped = better.join(target, "class_id", "left").select(
            "id", "before", F.coalesce("further", "class_id").alias("class_id")
        )
        jumped = materialized(jumped, f"{label}-{turn}")
        classes = jumped.select("id", "class_id")
        if jumped.filter("before != class_id").isEmpty():
            return classes


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sketches of all rows, and (same1, same2, head) of every distinct text.

    ``head`` is the first row of the text's class: (unnamed, doc_id, row).
    """
    drawn = materialized(sketches(docs), "omh-sketches")
    same = ["same1", "same2"]
    # The numbers of the texts are pinned by the written table.
    texts = materialized(
        drawn.groupBy(*same)
        .agg(
            F.min(F.struct("unnamed", "doc_id", "row")).alias("head"),
            *(F.first(c).alias(c) for c in ("n", "keys", *BIT_COLUMNS)),
        )
        .withColumn("id", F.monotonically_increasing_id()),
        "omh-texts",
    )
    bands = texts.select("id", "n", *BIT_COLUMNS, F.explode("keys").alias("key"))
    shared = bands.groupBy("key").agg(
        F.count("*").alias("texts"),
        *(F.min_by("id", F.xxhash64("id", F.lit(s))).alias(f"leader{s}") for s in range(LEADERS)),
    ).filter("texts > 1")
    bands = materialized(bands.join(shared, "key"), "omh-bands")

    facts = texts.select(*(F.col(c).alias(f"other_{c}") for c in ("id", "n", *BIT_COLUMNS)))
    leaders = F.array_distinct(F.array(*(f"leader{s}" for s in range(LEADERS))))
    led = (
        bands.select("id", "n", *BIT_COLUMNS, F.explode(leaders).alias("other_id"))
        .filter("id != other_id")
        .distinct()
        .join(facts, "other_id")
        .filter(_may_be_alike())
        .select(F.least("id", "other_id").alias("id"), F.greatest("id", "other_id").alias("other_id"))
        .distinct()
    )
    led = materialized(led, "omh-led")
    # Word hashes of the texts that are candidates at all.
    wanted = texts.select("id", F.col("head.row").alias("row")).join(
        bands.select("id").distinct(), "id", "left_semi"
    )
    content = materialized(_content(docs, wanted), "omh-content")
    links = materialized(_verify(led, content), "omh-links")
    classes = components(links, "omh-classes")

    # Texts of a key that are still in different classes, where not all were compared.
    placed = (
        bands.filter(F.col("texts") > 2)
        .select("key", "texts", "id", "n", *BIT_COLUMNS)
        .join(classes, "id", "left")
        .withColumn("class_id", F.coalesce("class_id", "id"))
    )
    placed = materialized(placed, "omh-placed")
    split = (
        placed.groupBy("key")
        .agg(F.min("class_id").alias("low"), F.max("class_id").alias("high"))
        .filter("low != high")
        .select("key")
    )
    open_ = materialized(placed.join(split, "key", "left_semi"), "omh-open")
    few = open_.filter(F.col("texts") <= HOT)
    rest = (
        few.join(_other(few), "key")
        .filter("class_id != other_class_id and id < other_id")
        .filter(_may_be_alike())
        .select("id", "other_id")
        .distinct()
        .join(led, ["id", "other_id"], "left_anti")
    )
    more = _verify(materialized(rest, "omh-rest"), content).unionByName(
        _verify_hot(open_.filter(F.col("texts") > HOT), texts.select("id", "keys"), content)
    )
    more = materialized(more, "omh-more")
    if not more.isEmpty():
        classes = components(links.unionByName(more), "omh-all")
    named = (
        texts.select("id", *same, "head")
        .join(classes, "id", "left")
        .withColumn("class_id", F.coalesce("class_id", "id"))
    )
    heads = named.groupBy("class_id").agg(F.min("head").alias("head"))
    return drawn, named.drop("head").join(heads, "class_id").select(*same, "head")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id) of every row of ``docs``."""
    drawn, named = _classes(docs)
    return (
        drawn.select("unnamed", "doc_id", "same1", "same2")
        .join(named, ["same1", "same2"])
        .select(
            F.when(~F.col("unnamed"), F.col("doc_id")).alias("doc_id"),
            F.when(~F.col("head.unnamed"), F.col("head.doc_id")).alias("class_id"),
        )
    )


def _verify_hot(hot: DataFrame, keys: DataFrame, content: DataFrame) -> DataFrame:
    """Links between classes among the texts of hot keys, compared block by block.

    The texts of a key that are not in its largest class meet all of its texts, in
    blocks of ``BLOCK``; a task gives the links it finds, never the pairs.
    """
    sizes = hot.groupBy("key", "class_id").agg(F.count("*").alias("members"))
    largest = sizes.groupBy("key").agg(
        F.max_by("class_id", F.struct("members", "class_id")).alias("largest"),
        F.sum("members").alias("all"),
        (F.sum("members") - F.max("members")).alias("others"),
    )
    own = (
        hot.join(largest, "key")
        .join(keys, "id")
        .join(content, "id")
        .withColumn("minor", F.col("class_id") != F.col("largest"))
    )
    dealt = lambda count: F.ceil(F.col(count) / BLOCK).cast("int")
    place = lambda count: F.pmod(F.xxhash64("id"), dealt(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), dealt(count) - 1))
    kept = ["key", "id", "class_id", "n", *BIT_COLUMNS, "keys", "words", "minor"]
    own = materialized(own.select(*kept, "others", "all"), "omh-hot")
    left = own.filter("minor").withColumn("left", place("others")).withColumn("right", every("all"))
    right = own.withColumn("left", every("others")).withColumn("right", place("all"))
    right = right.select(*(F.col(c).alias(f"_{c}") for c in (*kept, "left", "right")))

    def compare(block: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        b.columns = [c[1:] for c in b.columns]
        return pd.DataFrame(_links(block[0], a, b), columns=["id", "other_id"], dtype="int64")

    return (
        left.select(*kept, "left", "right")
        .groupBy("key", "left", "right")
        .cogroup(right.groupBy("_key", "_left", "_right"))
        .applyInPandas(compare, "id long, other_id long")
    )


def _links(key: int, a: pd.DataFrame, b: pd.DataFrame) -> list[tuple[int, int]]:
    """Links that join classes; what a link has joined needs no other."""
    if not len(a) or not len(b):
        return []
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while (up := parent.get(c, c)) != c:
            c = up
        return c

    grams = [
        [kmers(np.frombuffer(w, np.uint32)) for w in own["words"]] for own in (a, b)
    ]
    bits = [own[BIT_COLUMNS].to_numpy(np.int64).view(np.uint64) for own in (a, b)]
    bands = [np.stack([np.asarray(k[:BANDS], np.int64) for k in own["keys"]]) for own in (a, b)]
    exact = [[set(k[BANDS:]) for k in own["keys"]] for own in (a, b)]
    sizes = [own["n"].to_numpy(float) for own in (a, b)]
    ids = [own["id"].to_numpy() for own in (a, b)]
    groups = [own["class_id"].to_numpy() for own in (a, b)]
    minor = b["minor"].to_numpy(bool)
    out = []
    for i in range(len(a)):
        apart = np.bitwise_count(bits[0][i] ^ bits[1]).sum(axis=1)
        low, high = np.minimum(sizes[0][i], sizes[1]), np.maximum(sizes[0][i], sizes[1])
        fits = ((apart <= MOST_APART) | (low <= SHORT)) & (low >= high * LEAST - 1e-9)
        fits &= (groups[1] != groups[0][i]) & ~(minor & (ids[1] <= ids[0][i]))
        near = np.flatnonzero(fits)
        # A pair is compared under the first key that it shares.
        same = bands[1][near] == bands[0][i]
        under = bands[0][i][same.argmax(axis=1)]
        for k in np.flatnonzero(~same.any(axis=1)):
            under[k] = min(exact[0][i] & exact[1][near[k]], default=key)
        near = near[under == key]
        for j in near[np.argsort(apart[near], kind="stable")]:
            one, other = root(groups[0][i]), root(groups[1][j])
            if one != other and aligned(grams[0][i], grams[1][j]):
                out.append((int(ids[0][i]), int(ids[1][j])))
                parent[max(one, other)] = min(one, other)
    return out


def _content(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, words) of the wanted (id, row)."""
    chosen = _identified(docs).select("row", "text").join(wanted, "row").select("id", "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for some in _batches(frames):
            words = hasher.words(some["text"].tolist())
            yield pd.DataFrame(
                {"id": some["id"].to_numpy(), "words": [w.tobytes() for w in words]}
            )

    return chosen.mapInPandas(run, "id long, words binary").dropDuplicates(["id"])


def distinct(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` of every class, of those that name it."""
    _, named = _classes(docs)
    kept = named.select(F.col("head.row").alias("row")).distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # The removal of repeated rows, which begins before it, and the join share one exchange.
    packed = docs.select(F.struct(*columns).alias("doc"), _row().alias("row"))
    return packed.dropDuplicates(["row"]).join(kept, "row", "left_semi").select("doc.*")
