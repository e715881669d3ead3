"""Token ids in fixed-width bit-packed shard files.

A shard file is a run of blocks, an index and a trailer:

* block: ``BLOCK`` ids (the last one fewer), each in ``bits`` bits, least
  significant bit first, padded to whole bytes; ``bits`` is the least width that
  holds every id of the vocabulary;
* index: byte offset of every block, the first id of every document (both
  unsigned 64 bit, with one closing entry), the ids of the documents (signed 64
  bit) and one byte each that is 1 where the id was null;
* trailer: ``TRAILER``, little-endian.

With the offsets any range of ids is one read and one vectorised unpacking.

Documents are ordered by id (null first; equal ids by a hash of the text, then the
text, so that one id with many rows is spread too). A null text is an empty one:
its document consists of the end id alone. Repeated rows are written each by
itself. An empty table gives no shard and no rows. Other columns are not read.

A task writes under a name of its own and then moves the file to its final name,
so a repeated task replaces its file by an equal one. Files go to a folder that
pyarrow's file systems reach: a path, or a file, s3, gs or hdfs address.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mirrorspan.llm.blocks import gathered
from mirrorspan.llm.common import materialized

BLOCK = 4096
# Characters encoded at once.
BATCH_CHARS = 2_000_000
MAGIC = b"MSIDS001"
# magic, bits, ids a block, blocks, documents, ids, offset of the index
TRAILER = struct.Struct("<8sIIQQQQ")


def width(vocabulary: int) -> int:
    """The least number of bits that holds the ids 0 to ``vocabulary - 1``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = np.unpackbits(
        ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little"
    )
    return np.packbits(planes[:, :bits], bitorder="little").tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    planes = np.unpackbits(
        np.frombuffer(data, np.uint8), count=count * bits, bitorder="little"
    ).reshape(count, bits)
    whole = np.zeros((count, 32), np.uint8)
    whole[:, :bits] = planes
    return np.packbits(whole, axis=1, bitorder="little").view("<u4").ravel()


class _Numbers(dict):
    """Gives every new key the next number."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class _Growing:
    """An array that is appended to, with room to spare."""

    def __init__(self, dtype):
        self.values = np.zeros(1024, dtype)
        self.n = 0

    def extend(self, more: np.ndarray) -> None:
        end = self.n + len(more)
        if end > len(self.values):
            grown = np.zeros(max(end, 2 * len(self.values)), self.values.dtype)
            grown[: self.n] = self.values[: self.n]
            self.values = grown
        self.values[self.n : end] = more
        self.n = end


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: itself if it is printable,
    else the next free one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class ChunkEncoder:
    """Encodes texts as the tokenizer does, each distinct chunk between blanks once.

    For byte-level tokenizers that lower their input, drop white space, never join what
    stands on its two sides, and part letters from other signs before merging. A chunk of
    plain Latin letters, with marks after them at most, goes to the merges at once;
    any other goes through the whole tokenizer.
    """

    MOST = 500_000  # chunks remembered; beyond it the half that is met most stays
    # Letters that normalising leaves as they are and every version of Unicode knows; not
    # the dotted capital I, which becomes a letter and a mark.
    PLAIN = re.compile(
        "([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+)([,.;:!?]*)"
    )

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.letters = _byte_letters()
        self.marks: dict[str, list[int]] = {}
        self._start()

    def _start(self) -> None:
        self.number = _Numbers()
        self.firsts, self.sizes = _Growing(np.int64), _Growing(np.int64)
        self.met, self.flat = _Growing(np.int64), _Growing(np.uint32)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _add(self, sizes: np.ndarray, ids: np.ndarray, met: np.ndarray) -> None:
        self.firsts.extend(self.flat.n + np.cumsum(sizes) - sizes)
        self.sizes.extend(sizes)
        self.met.extend(met)
        self.flat.extend(ids)

    def _forget(self) -> None:
        """Keeps the half that was met most."""
        n = len(self.number)
        kept = np.zeros(n, bool)
        kept[np.argpartition(-self.met.values[:n], n // 2)[: n // 2]] = True
        words = list(itertools.compress(self.number, kept.tolist()))
        at = np.flatnonzero(kept)
        sizes, met = self.sizes.values[at], self.met.values[at]
        ids = gathered(self.flat.values, self.firsts.values, self.sizes.values, at)
        self._start()
        for word in words:
            self.number[word]
        self._add(sizes, ids, met // 2)

    def _chunk_ids(self, chunk: str) -> list[int]:
        plain = self.PLAIN.fullmatch(chunk)
        if plain is None:
            return self._ids(chunk)
        word, marks = plain.groups()
        word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.merges.tokenize(word)]
        if marks:
            if marks not in self.marks:
                if len(self.marks) > 10_000:
                    self.marks = {}
                self.marks[marks] = self._ids(marks)
            ids += self.marks[marks]
        return ids

    def _learn(self, chunks: list[str]) -> None:
        found = list(map(self._chunk_ids, chunks))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(sizes.sum()))
        self._add(sizes, ids, np.zeros(len(chunks), np.int64))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        if len(self.number) > self.MOST:
            self._forget()
        texts = [t.replace("\n", " ") for t in texts]
        known = len(self.number)
        chunks = " ".join(texts).split(" ")
        at = np.fromiter(map(self.number.__getitem__, chunks), np.int64, len(chunks))
        if len(self.number) > known:
            self._learn(list(itertools.islice(self.number, known, None)))
        self.met.values[: len(self.number)] += np.bincount(at, minlength=len(self.number))
        ids = gathered(self.flat.values, self.firsts.values, self.sizes.values, at)
        end = np.cumsum(self.sizes.values[at])
        n_chunks = np.cumsum([t.count(" ") + 1 for t in texts])
        return np.split(ids, end[n_chunks[:-1] - 1])


@functools.lru_cache(maxsize=2)
def chunk_encoder(path: str) -> ChunkEncoder:
    """One encoder a Python worker, kept from task to task with what it has met."""
    return ChunkEncoder(path)


class ShardWriter:
    """Writes one shard; ``add`` takes documents in order."""

    def __init__(self, folder: str, name: str, bits: int):
        self.files, base = fs.FileSystem.from_uri(folder)
        self.path = f"{base}/{name}"
        self.draft = f"{base}/_{name}.{uuid.uuid4().hex}"
        self.bits = bits
        self.out = self.files.open_output_stream(self.draft)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0
        self.offsets = [0]
        self.starts = [0]
        self.doc_ids: list[int] = []
        self.nulls: list[bool] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.starts.append(self.starts[-1] + len(ids))
        self.doc_ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        if self.n_waiting >= 64 * BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        end = len(ids) if last else len(ids) // BLOCK * BLOCK
        for at in range(0, end, BLOCK):
            data = pack(ids[at : min(at + BLOCK, end)], self.bits)
            self.out.write(data)
            self.offsets.append(self.offsets[-1] + len(data))
        self.waiting, self.n_waiting = [ids[end:]], len(ids) - end

    def close(self) -> tuple[int, int]:
        """Number of documents and of ids."""
        self._flush(True)
        index = self.offsets[-1]
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(np.array(self.doc_ids, "<i8").tobytes())
        self.out.write(np.array(self.nulls, np.uint8).tobytes())
        self.out.write(
            TRAILER.pack(
                MAGIC, self.bits, BLOCK, len(self.offsets) - 1,
                len(self.doc_ids), self.starts[-1], index,
            )
        )
        self.out.close()
        self.files.move(self.draft, self.path)
        return len(self.doc_ids), self.starts[-1]


class ShardReader:
    """Random access to one shard file."""

    def __init__(self, folder: str, name: str):
        files, base = fs.FileSystem.from_uri(folder)
        self.file = files.open_input_file(f"{base}/{name}")
        size = self.file.size()
        magic, self.bits, self.block, blocks, docs, self.n_ids, index = TRAILER.unpack(
            self.file.read_at(TRAILER.size, size - TRAILER.size)
        )
        if magic != MAGIC:
            raise ValueError(f"{name} is not a shard of token ids")
        data = self.file.read_at(size - TRAILER.size - index, index)
        self.offsets = np.frombuffer(data, "<u8", blocks + 1)
        at = 8 * (blocks + 1)
        self.starts = np.frombuffer(data, "<u8", docs + 1, at).astype(np.int64)
        at += 8 * (docs + 1)
        self.doc_ids = np.frombuffer(data, "<i8", docs, at)
        self.nulls = np.frombuffer(data, np.uint8, docs, at + 8 * docs).astype(bool)

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids ``begin`` to ``end`` (exclusive) of the shard, in one read."""
        if begin >= end:
            return np.zeros(0, np.uint32)
        first, last = begin // self.block, (end - 1) // self.block
        start = int(self.offsets[first])
        data = self.file.read_at(int(self.offsets[last + 1]) - start, start)
        if self.bits * self.block % 8 == 0:
            count = min((last + 1) * self.block, self.n_ids) - first * self.block
            got = unpack(data, count, self.bits)
        else:  # blocks end in padding
            got = np.concatenate([
                unpack(
                    data[int(self.offsets[b]) - start : int(self.offsets[b + 1]) - start],
                    min(self.block, self.n_ids - b * self.block),
                    self.bits,
                )
                for b in range(first, last + 1)
            ])
        return got[begin - first * self.block : end - first * self.block]

    def documents(self, run: int = 512) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, first id in the shard, ids) of all documents, ``run`` a read."""
        for low in range(0, len(self.doc_ids), run):
            high = min(low + run, len(self.doc_ids))
            base = self.starts[low]
            ids = self.ids(base, self.starts[high])
            for k in range(low, high):
                begin, end = self.starts[k], self.starts[k + 1]
                yield (
                    None if self.nulls[k] else int(self.doc_ids[k]),
                    int(begin),
                    ids[begin - base : end - base],
                )


def write_shards(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, vocabulary: int
) -> DataFrame:
    """Writes (doc_id, text) to shard files; (shard, name, n_docs, n_ids) of each.

    The result is read from a table, so asking twice doesn't write twice.
    """
    files, base = fs.FileSystem.from_uri(folder)
    files.create_dir(base, recursive=True)
    bits = width(vocabulary)
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    parts = (
        docs.select("doc_id", text.alias("text"))
        .repartitionByRange(*keys[:2])
        .sortWithinPartitions(*keys)
        .select("doc_id", "text", F.spark_partition_id().alias("shard"))
    )

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, writer = chunk_encoder(tokenizer), None
        for frame in frames:
            if not len(frame):
                continue
            if writer is None:
                shard = int(frame["shard"].iloc[0])
                name = f"shard-{shard:06d}.ids"
                writer = ShardWriter(folder, name, bits)
            ends = np.cumsum(frame["text"].str.len().to_numpy(np.int64)) // BATCH_CHARS
            for _, some in frame.groupby(ends, sort=False):
                for doc_id, ids in zip(some["doc_id"], encoder.encode(some["text"].tolist())):
                    known = None if pd.isna(doc_id) else int(doc_id)
                    writer.add(known, np.append(ids, np.uint32(end_id)))
        if writer is not None:
            n_docs, n_ids = writer.close()
            yield pd.DataFrame(
                {"shard": [shard], "name": [name], "n_docs": [n_docs], "n_ids": [n_ids]}
            )

    schema = "shard int, name string, n_docs long, n_ids long"
    return materialized(parts.mapInPandas(write, schema), "shards")


def read_shards(shards: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    ``start`` counts the ids of all documents before it, over all shards.
    """
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file meets here, not one per document.
    placed = shards.withColumn("base", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, base in zip(frame["name"], frame["base"]):
                rows = [
                    (doc_id, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    for doc_id, start, ids in ShardReader(folder, name).documents()
                ]
                out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                yield out.astype({"doc_id": "Int64"})

    spread = placed.repartition(max(1, shards.count()))
    return spread.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
