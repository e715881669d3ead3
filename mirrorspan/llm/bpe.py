"""Byte-level BPE: encoding by a global shuffle of distinct words, decoding by a join.

The texts are split into pre-tokens. Each block of documents (``blocks``) sends every
distinct pre-token once, dealt into buckets by its hash; a shuffle by bucket brings
the blocks' equal ones together, where each is merged once by the ranks, and the ids go
back to the blocks. There the texts, meanwhile streams of pre-token numbers, become
streams of ids, so positions never leave the block. A hot pre-token travels once a block,
and there are as many buckets as the corpus asks for.

Ids are little-endian 32-bit numbers, one text's in one binary value.

The streams are split from the texts anew rather than stored. Should the input come
in another order then (it doesn't from files), a check of the words differs and
the job fails instead of mixing up ids.

Decoding joins the ids with the table of token bytes. That table has a row per rank,
50,256 here, and is refused beyond ``MOST_TOKENS``; it is sent to all tasks.

Pre-tokens are those of the pattern of the rank file's library, ``PATTERN``. Which code
points are letters, numbers and white space is asked of the library itself: regex
engines differ by their Unicode version.

Defined results: a null text is an empty one and has no ids; repeated rows and rows
of null or shared ids each have a row; an empty table gives no rows; only ``doc_id`` and
``text`` are read. Special tokens' strings are ordinary text.
"""

from __future__ import annotations

import base64
import functools
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mirrorspan.llm.blocks import (
    Numbers,
    block_ids,
    bucket_count,
    by_bucket,
    gathered,
    joined,
    packed,
    parted,
    unpacked,
    words_check,
)

# Fixed value: the split before the merges that ``Splitter`` stands for.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
LETTER, NUMBER, SPACE, OTHER, BREAK = range(5)
# A block ends with the document that brings it to so many characters or words.
BLOCK_CHARS = 8_000_000
BLOCK_WORDS = 200_000
# Characters split at once.
CHUNK = 400_000
# Documents that are handed on at once.
ROWS = 500
MOST_TOKENS = 2_000_000
# The planes that hold characters; what lies beyond is of no class of letters.
PROBED = [*range(0x80, 0x40000), *range(0xE0000, 0xE1000)]
# A blank after a word character: every split has a boundary before it.
SAFE = re.compile(r"(?<=\w) ")


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids, of a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (row.split() for row in lines if row.strip())}


@functools.lru_cache(maxsize=1)
def code_point_classes() -> bytes:
    """The class of every code point as the library's pattern sees it, compressed.

    A prefix of a known class, followed by a code point of the same class, is one
    pre-token, which a rank for the prefix and the first byte then makes visible.
    """
    import tiktoken

    points = [c for c in PROBED if not 0xD800 <= c < 0xE000]
    chars = [chr(c) for c in points]
    lines = [chars[k : k + 4096] for k in range(0, len(chars), 4096)]
    firsts = sorted({c.encode()[:1] for c in chars})
    classes = np.full(0x110000, OTHER, np.uint8)
    ascii_letters = [*range(65, 91), *range(97, 123)]
    classes[ascii_letters] = LETTER
    classes[48:58] = NUMBER
    classes[[9, 10, 11, 12, 13, 32]] = SPACE
    same = {}
    for kind, prefix in ((LETTER, "z"), (NUMBER, "1"), (OTHER, "#")):
        ranks = {bytes([k]): k for k in range(256)}
        ranks.update({prefix.encode() + f: 256 + k for k, f in enumerate(firsts)})
        encoding = tiktoken.Encoding(
            "classes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        found = encoding.encode_ordinary_batch(["\n".join(prefix + c for c in part) for part in lines])
        ids = np.concatenate([np.array(part, np.int64) for part in found])
        starts = ids[(ids == ord(prefix)) | (ids >= 256)]
        if len(starts) != len(points):
            raise RuntimeError("a code point hides the prefix before it")
        same[kind] = starts >= 256
    classes[points] = np.select(
        [same[LETTER], same[NUMBER], same[OTHER]], [LETTER, NUMBER, OTHER], SPACE
    )
    return zlib.compress(classes.tobytes())


class Splitter:
    """Splits texts into pre-tokens as ``PATTERN`` does, many texts at once."""

    def __init__(self, classes: bytes):
        self.classes = np.frombuffer(zlib.decompress(classes), np.uint8)

    def __call__(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """(all pre-tokens, their number in every text)."""
        whole = "\n".join(texts) + "\n"
        points = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        kind = self.classes[points]
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        kind[ends] = BREAK
        start = np.ones(len(kind), bool)
        start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == BREAK)
        # The last white space before a word is a pre-token, or a blank is the word's.
        space = kind == SPACE
        last = np.flatnonzero(space[:-1] & ~space[1:] & (kind[1:] != BREAK))
        start[last] = True
        start[last[points[last] == 0x20] + 1] = False
        self._contract(points, kind, start)
        begins = np.flatnonzero(start)
        kept = kind[begins] != BREAK
        stops = np.append(begins[1:], len(kind))[kept]
        begins = begins[kept]
        upto = np.searchsorted(begins, ends)
        found = [whole[a:b] for a, b in zip(begins.tolist(), stops.tolist())]
        return found, np.diff(upto, prepend=0)

    def _contract(self, points: np.ndarray, kind: np.ndarray, start: np.ndarray) -> None:
        """An apostrophe that begins a pre-token takes s, t, m, d, re, ve or ll with it."""
        marks = np.flatnonzero((points == 0x27) & start)
        marks = marks[kind[np.minimum(marks + 1, len(kind) - 1)] == LETTER]
        if not len(marks):
            return
        first, second = points[marks + 1], points[np.minimum(marks + 2, len(points) - 1)]
        one = np.isin(first, [ord(c) for c in "stmd"])
        two = (
            ((first == ord("r")) | (first == ord("v"))) & (second == ord("e"))
            | (first == ord("l")) & (second == ord("l"))
        )
        after = (marks + np.where(one, 2, 3))[one | two]
        start[marks[one | two] + 1] = False
        start[after[kind[after] == LETTER]] = True


def _segments(text: str) -> Iterator[str]:
    """A text in parts of about ``CHUNK`` characters, cut where a pre-token begins."""
    at = 0
    while len(text) - at > CHUNK:
        cut = SAFE.search(text, at + CHUNK)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class _Block:
    """Documents of a block: their ids, and their pre-tokens as numbers."""

    def __init__(self):
        self.numbers = Numbers()
        self.parts: list[np.ndarray] = []
        self.chars = 0
        self.doc_ids: list[int | None] = []
        self.sizes: list[int] = []

    def full(self) -> bool:
        return self.chars >= BLOCK_CHARS or len(self.numbers) >= BLOCK_WORDS

    def add(self, ids: list[int | None], texts: list[str], split: Splitter) -> None:
        waiting, owners, held = [], [], 0
        sizes = np.zeros(len(texts), np.int64)

        def flush():
            found, counts = split(waiting)
            np.add.at(sizes, owners, counts)
            self.parts.append(
                np.fromiter(map(self.numbers.__getitem__, found), np.uint32, len(found))
            )

        for k, text in enumerate(texts):
            for part in _segments(text):
                waiting.append(part)
                owners.append(k)
                held += len(part)
                if held >= CHUNK:
                    flush()
                    waiting, owners, held = [], [], 0
        if waiting:
            flush()
        self.chars += sum(map(len, texts))
        self.doc_ids += ids
        self.sizes += sizes.tolist()


def _blocks(batches: Iterator[pa.RecordBatch], classes: bytes) -> Iterator[tuple[int, _Block]]:
    """The blocks of one input partition."""
    split, ids, block = Splitter(classes), block_ids(), _Block()
    for batch in batches:
        doc_ids = batch.column("doc_id").to_pylist()
        texts = batch.column("text")
        low = 0
        while low < len(doc_ids):
            high, held = low, 0
            while high < len(doc_ids) and held < CHUNK:
                held += len(texts[high].as_py())
                high += 1
            block.add(doc_ids[low:high], texts.slice(low, high - low).to_pylist(), split)
            low = high
            if block.full():
                yield next(ids), block
                block = _Block()
    if block.doc_ids:
        yield next(ids), block


def _source(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


@functools.lru_cache(maxsize=2)
def _merger(path: str):
    """Merges one pre-token, whatever it consists of."""
    import tiktoken

    return tiktoken.Encoding(
        "merges", pat_str=r"[\s\S]+", mergeable_ranks=load_ranks(path), special_tokens={}
    ).encode_ordinary


def _word_rows(block_id: int, words: list[bytes], buckets: int) -> pa.RecordBatch:
    """The words of a block, one row a bucket."""
    order, bucket = by_bucket(words, buckets)
    begins = np.flatnonzero(np.diff(bucket, prepend=-1))
    ordered = [words[k] for k in order.tolist()]
    ends = [*begins[1:].tolist(), len(words)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[begins].astype(np.int32)),
            pa.array(np.full(len(begins), block_id)),
            pa.array(np.full(len(begins), words_check(words))),
            pa.array([joined(ordered[a:b]) for a, b in zip(begins.tolist(), ends)], pa.binary()),
        ],
        ["bucket", "block", "check", "words"],
    )


def _encode_bucket(rows: pa.Table, path: str) -> pa.Table:
    """The ids of a bucket's words, each distinct one merged once, by block."""
    merge, known = _merger(path), {}
    sizes, ids = [], []
    for data in rows.column("words"):
        found = []
        for word in parted(data.as_py()):
            own = known.get(word)
            if own is None:
                own = known[word] = merge(word.decode())
            found.append(own)
        sizes.append(packed(np.fromiter(map(len, found), np.uint32, len(found))))
        ids.append(packed(np.fromiter(itertools.chain.from_iterable(found), np.uint32)))
    return pa.table({
        "bucket": rows.column("bucket"), "block": rows.column("block"), "check": rows.column("check"),
        "sizes": pa.array(sizes, pa.binary()), "ids": pa.array(ids, pa.binary()),
    })


def _stream_row(block_id: int, block: _Block, buckets: int) -> pa.RecordBatch:
    """The texts of a block as numbers, and the order in which its words are sent."""
    words = [w.encode() for w in block.numbers]
    numbers = np.concatenate(block.parts) if block.parts else np.zeros(0, np.uint32)
    order, bucket = by_bucket(words, buckets)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block_id]),
            pa.array([words_check(words)]),
            pa.array([packed(numbers)], pa.binary()),
            pa.array([packed(order)], pa.binary()),
            pa.array([len(np.unique(bucket))], pa.int32()),
            pa.array([block.doc_ids], pa.list_(pa.int64())),
            pa.array([block.sizes], pa.list_(pa.int64())),
        ],
        ["block", "check", "numbers", "order", "buckets", "doc_ids", "sizes"],
    )


def _assemble(ids: pa.Table, stream: pa.Table) -> pa.Table:
    """The ids of every document of a block."""
    checks = {*ids.column("check").to_pylist(), *stream.column("check").to_pylist()}
    if len(checks) != 1 or stream.num_rows != 1 or stream.column("buckets")[0].as_py() != ids.num_rows:
        raise RuntimeError("the input came in another order when it was read again")
    ids = ids.sort_by("bucket")
    sizes, flat = (
        np.concatenate([unpacked(b.as_py()) for b in ids.column(c)] or [np.zeros(0, "<u4")])
        for c in ("sizes", "ids")
    )
    order = unpacked(stream.column("order")[0].as_py())
    firsts, ordered = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    firsts[order] = np.cumsum(sizes, dtype=np.int64) - sizes
    ordered[order] = sizes
    at = unpacked(stream.column("numbers")[0].as_py())
    doc_ids, doc_sizes = stream.column("doc_ids")[0].values, stream.column("sizes")[0].values
    ends = np.cumsum(doc_sizes.to_numpy())
    found, low = [], 0
    while low < len(ends):  # some documents at once, whatever their number of pre-tokens
        begin = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, begin + CHUNK // 4, side="right")))
        high = min(high, low + ROWS)
        own = at[begin : ends[high - 1]]
        values = gathered(flat, firsts, ordered, own).astype("<u4")
        cuts = np.append(0, np.cumsum(ordered[own]))[ends[low:high] - begin]
        ids = pa.array([v.tobytes() for v in np.split(values, cuts[:-1])], pa.binary())
        found.append(pa.RecordBatch.from_arrays([doc_ids.slice(low, high - low), ids], ["doc_id", "ids"]))
        low = high
    return pa.Table.from_batches(found, pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())]))


def encode(docs: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` by the rank file ``ranks``."""
    classes = code_point_classes()
    source = _source(docs)
    chars = source.agg(F.sum(F.char_length("text"))).first()[0] or 0
    buckets = bucket_count(chars)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block_id, block in _blocks(batches, classes):
            if block.numbers:
                yield _word_rows(block_id, [w.encode() for w in block.numbers], buckets)

    def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block_id, block in _blocks(batches, classes):
            yield _stream_row(block_id, block, buckets)

    spread = source.mapInArrow(words, "bucket int, block long, check long, words binary")
    ids = spread.groupBy("bucket").applyInArrow(
        lambda rows: _encode_bucket(rows, ranks),
        "bucket int, block long, check long, sizes binary, ids binary",
    )
    stream = source.mapInArrow(
        streams,
        "block long, check long, numbers binary, order binary, buckets int, "
        "doc_ids array<long>, sizes array<long>",
    )
    return (
        ids.groupBy("block").cogroup(stream.groupBy("block"))
        .applyInArrow(_assemble, "doc_id long, ids binary")
    )


@functools.lru_cache(maxsize=2)
def _token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The table of token bytes: all bytes, and the first and number of each id's."""
    ranks = load_ranks(path)
    if len(ranks) > MOST_TOKENS:
        raise ValueError(f"{len(ranks)} tokens are too many to send to every task")
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    ordered = sorted(ranks.items(), key=lambda item: item[1])
    for token, rank in ordered:
        sizes[rank] = len(token)
    values = np.frombuffer(b"".join(token for token, _ in ordered), np.uint8)
    return values, np.cumsum(sizes) - sizes, sizes


def _decode_ids(ids: np.ndarray, path: str) -> bytes:
    values, firsts, sizes = _token_bytes(path)
    if len(ids) and ids.max() >= len(sizes):
        raise ValueError("an id is not in the vocabulary")
    return b"".join(
        gathered(values, firsts, sizes, ids[low : low + CHUNK]).tobytes()
        for low in range(0, len(ids), CHUNK)
    )


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ``ids``; null ids have none."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, ROWS):
                batch = whole.slice(low, ROWS)
                found = [
                    _decode_ids(np.frombuffer(ids.as_buffer(), "<u4"), ranks) if ids.is_valid else None
                    for ids in batch.column("ids")
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, "decoded"]
                )

    schema = T.StructType([*encoded.schema, T.StructField("decoded", T.BinaryType())])
    return encoded.mapInArrow(join, schema)


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
