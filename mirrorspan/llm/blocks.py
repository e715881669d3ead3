"""Blocks of documents as numbers of their distinct words.

What is said once per distinct word travels once per block, not once per occurrence:
a block is a run of documents of one input partition, its words are numbered in order
of arrival, and its texts are a stream of those numbers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext

# A block ends with the document that brings it to so many characters or words.
BLOCK_CHARS = 16_000_000
BLOCK_WORDS = 400_000


# Characters of the corpus for each bucket of words, so that a bucket's words fit a task.
BUCKET_CHARS = 16_000_000
LEAST_BUCKETS = 64
# Between words stands a byte that UTF-8 doesn't use.
SEAM = b"\xff"


def bucket_count(chars: int) -> int:
    return max(LEAST_BUCKETS, chars // BUCKET_CHARS)


def by_bucket(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the words, by bucket; bucket of each of these)."""
    bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
    order = np.argsort(bucket, kind="stable")
    return order, bucket[order]


def joined(words: list[bytes]) -> bytes:
    """One or more words, compressed together."""
    return zstandard.ZstdCompressor(level=3).compress(SEAM.join(words))


def parted(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split(SEAM)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32, compressed."""
    return zstandard.ZstdCompressor(level=3).compress(numbers.astype("<u4").tobytes())


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u4")


class Numbers(dict):
    """Gives every new key the next number."""

    def __missing__(self, key) -> int:
        self[key] = number = len(self)
        return number


def block_ids() -> Iterator[int]:
    """Ids of this task's blocks, the same whenever the task runs again."""
    part = TaskContext.get().partitionId()
    return iter(range(part << 32, (part + 1) << 32))


def words_check(words: Iterable[bytes]) -> int:
    """Tells whether two runs of a task numbered the same words."""
    return zlib.crc32(b"\n".join(words))


def gathered(values: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, at: np.ndarray):
    """``values[firsts[k] : firsts[k] + sizes[k]]`` of every k in ``at``, one after another."""
    size = sizes[at]
    end = np.cumsum(size)
    if not len(end):
        return values[:0]
    return values[np.arange(end[-1]) + np.repeat(firsts[at] - end + size, size)]


def lists(sizes: np.ndarray, values: pa.Array) -> pa.ListArray:
    """An Arrow list of ``sizes[k]`` values for every k."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)
