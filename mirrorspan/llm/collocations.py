"""Phrase collocations, counted by multikey three-way quicksort of suffix pointers.

1. Each block of documents (``blocks``) counts its distinct words per language. Dealt into
   buckets by their hash, the words of all blocks are summed, which gives n and the
   words that stand often enough to be part of a candidate. These are numbered, and each
   block learns the numbers of its own. All other words, and the ends of pieces, end a phrase.
2. Every block turns its texts into those numbers, cuts the suffix of ``DEPTH`` words
   at each place, and merges its equal suffixes. The texts are read anew for it rather than
   stored; should they come in another order then (from files they don't), a check
   of the words differs and the job fails instead of mixing up numbers.
3. Suffixes are routed by their leading words: by the first word, if that stands at
   most ``HOT`` times; else by the words up to the first such one, else by
   the whole suffix. So no group holds more than ``HOT`` suffixes of one route, or one
   row a block if all its words are hot, and there are as many groups as the corpus
   asks for.
4. In a group, pointers to the suffixes are sorted by three-way partitioning, word by
   word. The size of an equal partition is the count of its prefix; partitions
   that cannot reach the least count are abandoned with all below them. Prefixes
   of hot words alone may lie in several groups; they are never abandoned and their
   parts are summed.
5. Candidates meet the counts of their parts by joins.

Arithmetic is exact: counts are whole numbers and products decimals of 38 digits.

Defined results: a null text is an empty one; a null language is ``und``; repeated rows
and rows of null or shared ids all count; an empty table and one without candidates give
no rows; only ``text`` and ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirrorspan.llm.blocks import (
    BLOCK_CHARS,
    BLOCK_WORDS,
    Numbers,
    block_ids,
    bucket_count,
    by_bucket,
    joined,
    packed,
    parted,
    unpacked,
    words_check,
)
from mirrorspan.llm.common import materialized

DEPTH = 5
LEAST = 100
TOP = 2000
HOT = 1 << 19
# Characters split at once.
CHUNK = 2_000_000
# Suffixes that are cut, merged and routed at once.
SUFFIXES = 2_000_000

# Numbers of no word and of the end of a piece; those of words begin after them.
ABSENT, BREAK, FIRST = 0, 1, 2
# A-Z are lowered, tabs are blanks, ends of pieces are line feeds; other bytes stay.
_BYTES = bytearray(range(256))
_BYTES[65:91] = bytes(range(97, 123))
_BYTES[9] = 32
for _mark in b".,;:!?\x0a\x0b\x0c\x0d":
    _BYTES[_mark] = 10
_BYTES = bytes(_BYTES)
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * _MIX[1]
    x = (x ^ x >> np.uint64(27)) * _MIX[2]
    return x ^ x >> np.uint64(31)


class _Block:
    """Words of one block, a numbering for each language."""

    def __init__(self):
        self.numbers: dict[str, Numbers] = {}
        self.parts: dict[str, list[np.ndarray]] = {}
        self.size = 0

    def full(self) -> bool:
        return self.size >= BLOCK_CHARS or sum(map(len, self.numbers.values())) >= BLOCK_WORDS

    def add(self, lang: str, texts: list[bytes]) -> None:
        numbers = self.numbers.get(lang)
        if numbers is None:
            numbers = self.numbers[lang] = Numbers({b"": ABSENT, b"\n": BREAK})
            self.parts[lang] = []
        data = b"\n".join(texts).translate(_BYTES)
        words = data.replace(b"\n", b" \n ").split(b" ")
        found = np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words))
        self.parts[lang] += [found[found != ABSENT], np.array([BREAK], np.uint32)]
        self.size += len(data)

    def words(self, block_id: int, buckets: int) -> Iterator[pa.RecordBatch]:
        """For each language a row for the words of a bucket, with their counts."""
        for lang, numbers in self.numbers.items():
            words = list(numbers)[FIRST:]
            if not words:
                continue
            counts = np.bincount(np.concatenate(self.parts[lang]), minlength=len(numbers))[FIRST:]
            order, bucket = by_bucket(words, buckets)
            begins = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
            spans = list(zip(begins, [*begins[1:], len(words)]))
            ordered, sums = [words[k] for k in order.tolist()], counts[order]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block_id] * len(spans), pa.int64()),
                    pa.array([words_check(words)] * len(spans), pa.int64()),
                    pa.array([lang] * len(spans), pa.string()),
                    pa.array(bucket[begins].astype(np.int32)),
                    pa.array([joined(ordered[a:b]) for a, b in spans], pa.binary()),
                    pa.array([packed(sums[a:b]) for a, b in spans], pa.binary()),
                ],
                ["block", "check", "lang", "bucket", "words", "numbers"],
            )

    def streams(self, block_id: int, buckets: int) -> Iterator[pa.RecordBatch]:
        """For each language the texts as numbers, and the order in which words are sent."""
        for lang, numbers in self.numbers.items():
            words = list(numbers)[FIRST:]
            if not words:
                continue
            order, _ = by_bucket(words, buckets)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block_id], pa.int64()),
                    pa.array([words_check(words)], pa.int64()),
                    pa.array([lang], pa.string()),
                    pa.array([packed(order)], pa.binary()),
                    pa.array([packed(np.concatenate(self.parts[lang]))], pa.binary()),
                ],
                ["_block", "_check", "_lang", "order", "stream"],
            )


WORDS_SCHEMA = "block long, check long, lang string, bucket int, words binary, numbers binary"
STREAMS_SCHEMA = "_block long, _check long, _lang string, order binary, stream binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, _Block]]:
    """The blocks of one input partition."""
    ids, block = block_ids(), _Block()
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        texts = batch.column("text").to_pylist()
        waiting: dict[str, list[bytes]] = {}
        held = 0
        for k, (lang, text) in enumerate(zip(langs, texts)):
            waiting.setdefault(lang, []).append(text)
            held += len(text)
            if held >= CHUNK or k == len(langs) - 1:
                for own, some in waiting.items():
                    block.add(own, some)
                waiting, held = {}, 0
                if block.full():
                    yield next(ids), block
                    block = _Block()
    if block.numbers:
        yield next(ids), block


def suffixes(stream: np.ndarray, low: int, high: int, depth: int) -> np.ndarray:
    """The (up to) ``depth`` words from each place of ``low`` to ``high`` on; 0 is an end.

    Suffixes of a single word are left out; 0 fills those that end before.
    """
    whole = np.zeros(high - low + depth, stream.dtype)
    seen = stream[low : high + depth]
    whole[: len(seen)] = seen
    starts = np.flatnonzero((whole[: high - low] != 0) & (whole[1 : high - low + 1] != 0))
    table = np.empty((len(starts), depth), np.uint32)
    table[:, 0], table[:, 1] = whole[starts], whole[starts + 1]
    for k in range(2, depth):
        table[:, k] = np.where(table[:, k - 1] != 0, whole[starts + k], 0)
    return table


def merged(table: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows as one, with the sum of their counts.

    Rows are brought together by a hash; only rows that are equal are merged.
    """
    if not len(table):
        return table, counts
    value = np.zeros(len(table), np.uint64)
    for k in range(table.shape[1]):
        value = _scramble(value * _MIX[0] + table[:, k] + np.uint64(1))
    order = np.argsort(value)
    table, counts = table[order], counts[order]
    first = np.ones(len(table), bool)
    first[1:] = (table[1:] != table[:-1]).any(axis=1)
    return table[first], np.add.reduceat(counts, np.flatnonzero(first))


def routes(table: np.ndarray, leading: np.ndarray, groups: int) -> np.ndarray:
    """The group of every suffix: a hash of its words up to the first that isn't hot.

    ``leading`` is the number of hot words that each begins with.
    """
    value = np.zeros(len(table), np.uint64)
    for k in range(table.shape[1]):
        mixed = _scramble(value * _MIX[0] + table[:, k] + np.uint64(1))
        value = np.where(leading >= k, mixed, value)
    return (value % np.uint64(groups)).astype(np.int64)


def prefix_counts(
    table: np.ndarray, counts: np.ndarray, hot: np.ndarray, least: int
) -> tuple[list[np.ndarray], list[int]]:
    """Prefixes of two or more words and their counts, by three-way quicksort of pointers.

    ``hot`` tells of each suffix how many of its first words are hot: prefixes of these
    are returned whatever their count, others from ``least`` on.
    """
    prefixes: list[np.ndarray] = []
    sizes: list[int] = []
    depth = table.shape[1]
    columns = [np.ascontiguousarray(table[:, k]) for k in range(depth)]
    waiting = [(np.arange(len(table)), 0, int(counts.sum()), bool((hot > 0).any()))]
    while waiting:
        pointers, at, size, keep = waiting.pop()
        if not len(pointers) or size < least and not keep:
            continue  # abandoned: no prefix in it can reach the count
        words = columns[at][pointers]
        pivot = words[len(words) // 2]
        equal = words == pivot
        if not equal.all():
            for part in (words < pivot, words > pivot):
                some = pointers[part]
                waiting.append(
                    (some, at, int(counts[some].sum()), keep and bool((hot[some] > at).any()))
                )
            pointers = pointers[equal]
            size = int(counts[pointers].sum())
        if pivot == 0:
            continue  # ended before
        partial = keep and bool(hot[pointers[0]] > at)
        if size < least and not partial:
            continue
        if at:
            prefixes.append(table[pointers[0], : at + 1])
            sizes.append(size)
        if at + 1 < depth:
            waiting.append((pointers, at + 1, size, partial))
    return prefixes, sizes


def _key(words: np.ndarray) -> bytes:
    return words.astype(">u4").tobytes()


def _part(first: Column, words: Column) -> Column:
    """``words`` words of the phrase ``key`` from word ``first`` (from 0) on."""
    return F.substring(F.col("key"), 4 * first + 1, 4 * words)


BUCKET_SCHEMA = (
    "bucket int, lang string, block long, check long, ids binary, hot binary, word binary, "
    "id long, n long"
)


def _sum_bucket(rows: pa.Table, least: int, hot_count: int) -> pa.Table:
    """Sums a bucket's words over all blocks and numbers the frequent ones.

    Rows of a block hold the ids of its words (0: infrequent) and which of these are hot;
    rows of a word its id and count; rows of a language alone the count of all its words.
    Ids are the bucket's own, from 1.
    """
    bucket = rows.column("bucket")[0].as_py()
    langs, blocks, checks = (rows.column(c).to_pylist() for c in ("lang", "block", "check"))
    found: dict[str, Numbers] = {}
    places, counts = [], []
    for lang, words, numbers in zip(langs, rows.column("words"), rows.column("numbers")):
        own = found.setdefault(lang, Numbers())
        some = parted(words.as_py())
        places.append(np.fromiter(map(own.__getitem__, some), np.int64, len(some)))
        counts.append(unpacked(numbers.as_py()))
    sums = {lang: np.zeros(len(own), np.int64) for lang, own in found.items()}
    for lang, at, n in zip(langs, places, counts):
        sums[lang][at] += n
    ids, out, given = {}, [], 0
    for lang, own in found.items():
        frequent = np.flatnonzero(sums[lang] >= least)
        ids[lang] = np.zeros(len(own), np.int64)
        ids[lang][frequent] = np.arange(given + 1, given + len(frequent) + 1)
        given += len(frequent)
        words, chosen = list(own), frequent.tolist()
        out += [
            (bucket, lang, *[None] * 4, words[k], int(ids[lang][k]), int(sums[lang][k]))
            for k in chosen
        ]
        out.append((bucket, lang, *[None] * 6, int(sums[lang].sum())))
    for lang, block, check, at in zip(langs, blocks, checks, places):
        own, hot = ids[lang][at], sums[lang][at] > hot_count
        out.append((
            bucket, lang, block, check, packed(own), packed(np.flatnonzero(hot & (own > 0))), *[None] * 3,
        ))
    types = [pa.int32(), pa.string(), *[pa.int64()] * 2, *[pa.binary()] * 3, *[pa.int64()] * 2]
    names = ["bucket", "lang", "block", "check", "ids", "hot", "word", "id", "n"]
    return pa.table({n: pa.array(list(c), t) for n, t, c in zip(names, types, zip(*out))})


def _cut(known: pa.Table, stream: pa.Table, depth: int, groups: int) -> pa.Table:
    """The merged suffixes of a block in one language, a row for each group."""
    known = known.sort_by("bucket")
    checks = {*known.column("check").to_pylist(), *stream.column("_check").to_pylist()}
    if len(checks) != 1 or stream.num_rows != 1:
        raise RuntimeError("the input came in another order when it was read again")
    numbers = unpacked(stream.column("stream")[0].as_py())
    order = unpacked(stream.column("order")[0].as_py())
    ids, hots, at = [], [], 0
    for own, hot, offset in zip(known.column("ids"), known.column("hot"), known.column("offset").to_pylist()):
        own = unpacked(own.as_py()).astype(np.int64)
        hots.append(unpacked(hot.as_py()).astype(np.int64) + at)
        ids.append(np.where(own > 0, own + offset, 0))
        at += len(own)
    ids = np.concatenate([*ids, np.zeros(0, np.int64)])
    if len(ids) != len(order):
        raise RuntimeError("a block's words came back incomplete")
    if len(ids) and ids.max() >= 1 << 32:
        raise ValueError("more than 2^32 frequent words")
    frequent = np.flatnonzero(ids)
    # The block's frequent words are numbered from 1; 0 is an end.
    own = np.zeros(FIRST + len(order), np.uint32)
    own[FIRST + order[frequent]] = np.arange(1, len(frequent) + 1, dtype=np.uint32)
    words = np.append(0, ids[frequent]).astype(np.uint32)
    is_hot = np.zeros(len(ids), bool)
    is_hot[np.concatenate([*hots, np.zeros(0, np.int64)])] = True
    hot = np.append(False, is_hot[frequent])
    mapped = own[numbers]
    parts = []
    for low in range(0, len(mapped), SUFFIXES):
        part = suffixes(mapped, low, min(len(mapped), low + SUFFIXES), depth)
        parts.append(merged(part, np.ones(len(part), np.int64)))
    table = np.concatenate([np.zeros((0, depth), np.uint32), *(t for t, _ in parts)])
    counts = np.concatenate([np.zeros(0, np.int64), *(c for _, c in parts)])
    if len(parts) > 1:
        table, counts = merged(table, counts)
    leading, going = np.zeros(len(table), np.uint8), np.ones(len(table), bool)
    for k in range(depth):
        going &= hot[table[:, k]]
        leading += going
    table = words[table]
    route = routes(table, leading, groups)
    # By the first word within a group, and column by column: so they compress well.
    order = np.argsort((route.astype(np.uint64) << np.uint64(32)) | table[:, 0], kind="stable")
    table, counts, leading, route = table[order], counts[order], leading[order], route[order]
    begins = np.flatnonzero(np.diff(route, prepend=-1))
    spans = list(zip(begins.tolist(), [*begins[1:].tolist(), len(route)]))
    return pa.table({
        "route": pa.array(route[begins], pa.int64()),
        "suffixes": pa.array([packed(table[a:b].T.ravel()) for a, b in spans], pa.binary()),
        "counts": pa.array([packed(counts[a:b]) for a, b in spans], pa.binary()),
        "leading": pa.array([packed(leading[a:b]) for a, b in spans], pa.binary()),
    })


def phrase_counts(
    docs: DataFrame, least: int = LEAST, depth: int = DEPTH, hot_count: int = HOT
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, phrases, totals).

    words: lang, word, n, key of each word that stands ``least`` times or more;
    phrases: key and n of each phrase of 2 to ``depth`` words that does; a key is four
    bytes for each word; totals: lang, n of all words.
    """
    source = docs.select(
        F.coalesce(F.col("lang"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    chars = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = bucket_count(chars)

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block_id, block in _blocks(batches):
            yield from block.words(block_id, buckets)

    def streams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block_id, block in _blocks(batches):
            yield from block.streams(block_id, buckets)

    summed = materialized(
        source.mapInArrow(words_of, WORDS_SCHEMA).groupBy("bucket").applyInArrow(
            lambda rows: _sum_bucket(rows, least, hot_count), BUCKET_SCHEMA
        ),
        "collocation-words",
    )
    totals = summed.filter("block IS NULL AND word IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    n_all = totals.agg(F.sum("n")).first()[0] or 0
    # One row a bucket.
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialized(
        summed.groupBy("bucket").agg(F.count("word").alias("given")).select(
            "bucket", F.coalesce(F.sum("given").over(earlier), F.lit(0)).alias("offset")
        ),
        "collocation-offsets",
    )
    words = materialized(
        summed.filter("word IS NOT NULL").join(offsets, "bucket").select(
            "lang", "word", "n",
            F.unhex(F.lpad(F.hex(F.col("id") + F.col("offset")), 8, "0")).alias("key"),
        ),
        "collocation-frequent",
    )
    known = (
        summed.filter("block IS NOT NULL").join(offsets, "bucket")
        .select("block", "check", "lang", "bucket", "ids", "hot", "offset")
    )
    streams = source.mapInArrow(streams_of, STREAMS_SCHEMA)
    groups = max(64, -(-n_all // hot_count))

    def cut(known: pa.Table, stream: pa.Table) -> pa.Table:
        return _cut(known, stream, depth, groups)

    routed = (
        known.groupBy("block", "lang").cogroup(streams.groupBy("_block", "_lang"))
        .applyInArrow(cut, "route long, suffixes binary, counts binary, leading binary")
    )

    def count(rows: pa.Table) -> pa.Table:
        table, counts, leading = (
            [unpacked(b.as_py()) for b in rows.column(c)] for c in ("suffixes", "counts", "leading")
        )
        prefixes, sizes = prefix_counts(
            np.concatenate([t.reshape(depth, -1).T for t in table]),
            np.concatenate(counts).astype(np.int64),
            np.concatenate(leading).astype(np.uint8),
            least,
        )
        return pa.table({
            "key": pa.array([_key(p) for p in prefixes], pa.binary()),
            "n": pa.array(sizes, pa.int64()),
        })

    parts = routed.groupBy("route").applyInArrow(count, "key binary, n long")
    phrases = materialized(
        parts.groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= least),
        "collocation-phrases",
    )
    return words, phrases, totals


# Candidates a salt; each salted part of a language hands on its best.
SALTED = 200_000


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    top: int = TOP,
    share: int = 100,
    depth: int = DEPTH,
    hot_count: int = HOT,
) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase stands ``least`` times or more. Its score is that of its worst cut,
    1000 * a * n / (l * r) rounded down, the first such cut. It is dropped if a longer one
    that holds it has at least ``share`` hundredths of its count.
    """
    words, phrases, totals = phrase_counts(docs, least, depth, hot_count)
    length = (F.octet_length("key") / 4).cast("int")
    # A longer phrase counts no more than what it holds, so one word more is enough.
    inner = phrases.filter(F.octet_length("key") > 8).select(
        "n", F.explode(F.array(_part(F.lit(0), length - 1), _part(F.lit(1), length - 1))).alias("key")
    )
    longer = inner.groupBy("key").agg(F.max("n").alias("longer"))
    own = (
        phrases.join(longer, "key", "left")
        .filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("n") * share))
        .select("key", F.col("n").alias("a"), _part(F.lit(0), F.lit(1)).alias("first"))
        .join(words.select(F.col("key").alias("first"), "lang"), "first")
        .join(totals, "lang")
        .drop("first")
    )
    counts = words.select("key", "n").unionByName(phrases)
    cuts = own.withColumn("k", F.explode(F.sequence(F.lit(1), length - 1))).withColumns(
        {"left": _part(F.lit(0), F.col("k")), "right": _part(F.col("k"), length - F.col("k"))}
    )
    scored = (
        cuts.join(counts.select(F.col("key").alias("left"), F.col("n").alias("l")), "left")
        .join(counts.select(F.col("key").alias("right"), F.col("n").alias("r")), "right")
        .withColumn(
            "score",
            F.expr(
                "CAST(1000 * a AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(19, 0)) "
                "div (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))"
            ),
        )
        .groupBy("lang", "key", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "key", "a", "n", "cut.score", "cut.l", "cut.r")
    )
    salts = 1 + phrases.count() // SALTED
    order = [F.col("score").desc(), F.col("a").desc()]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("key"), F.lit(salts))).orderBy(*order)
    best = scored.withColumn("_rank", F.rank().over(salted)).filter(F.col("_rank") <= top)
    if salts > 1:
        best = best.withColumn("_rank", F.rank().over(Window.partitionBy("lang").orderBy(*order)))
        best = best.filter(F.col("_rank") <= top)
    best = materialized(best.drop("_rank"), "collocation-best")
    spelled = (
        best.select("key", F.explode(F.sequence(F.lit(0), length - 1)).alias("at"))
        .withColumn("part", _part(F.col("at"), F.lit(1)))
        .join(words.select(F.col("key").alias("part"), F.col("word").cast("string")), "part")
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
        .select("key", F.array_join("words.word", " ").alias("phrase"))
    )
    ranked = Window.partitionBy("lang").orderBy(*order, "phrase")
    return (
        best.join(spelled, "key")
        .withColumn("rank", F.row_number().over(ranked).cast("long"))
        .filter(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
