"""Variable-capacity best-fit packing of documents into training sequences.

A sequence of c words costs c, an overhead, and attention that grows with the square of c.
Pieces are placed longest first, each in the open bin that it leaves the least
room in. When none has room, a bin is opened: for each permitted capacity it is
tried what the pieces still to come would fill it with, and the one whose cost for a
word so filled is least is taken. So long capacities serve long pieces, short ones keep
attention cheap, and a capacity whose room nothing fits is avoided. At the end every bin
shrinks to the cheapest capacity that holds its contents.

A document longer than the largest capacity is cut between words into pieces of
that capacity and a rest; the pieces of a document together are its whole text.

Every task packs the rows of its own partition in blocks of bounded size, so no
key, however frequent, gathers in one task. Bins that a block leaves less full than
``FULL`` are taken apart again, and the pieces of all blocks' such bins are packed
together, in as many tasks as their words ask for; so small partitions waste no more
than large ones.

Defined results: a null or empty text is one piece of no words and takes no room;
repeated rows and ids are packed one by one; a null id stays null; ties go to the
earlier piece, the bin opened first, and the smaller capacity; an empty table
gives no bins; other columns are not read.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorspan.llm.common import WORD, materialized, word_count

CAPACITIES = (512, 1024, 2048, 4096)
# What a sequence costs besides its words, in words: by itself, and by attention, which
# is as much as its words at so many of them.
OVERHEAD = 32
ATTENTION = 8192
# Bins of a block that are less full are packed again with those of other blocks.
FULL = 0.95
# Pieces that are tried when a capacity is chosen.
TRIED = 64
# A block ends with the document that reaches either number.
BLOCK_PIECES = 20_000
BLOCK_WORDS = 4_000_000

SCHEMA = (
    "bin long, capacity int, used int, doc_ids array<long>, "
    "starts array<long>, sizes array<int>"
)


def cost(capacity: int, overhead: int = OVERHEAD, attention: int = ATTENTION) -> float:
    """What a sequence of that many words costs."""
    return capacity + overhead + capacity * capacity / attention


class _Remaining:
    """Pieces still to be placed, longest first, by size."""

    def __init__(self, sizes: list[int]):
        self.counts: dict[int, int] = {}
        for size in sizes:
            self.counts[size] = self.counts.get(size, 0) + 1
        self.sizes = sorted(s for s in self.counts if s)

    def take(self, size: int) -> None:
        self.counts[size] -= 1
        if not self.counts[size] and size:
            del self.sizes[bisect.bisect_left(self.sizes, size)]

    def filling(self, room: int) -> int:
        """Words that the longest fitting pieces would put into the room."""
        filled, high = 0, len(self.sizes)
        for _ in range(TRIED):
            high = bisect.bisect_right(self.sizes, room - filled, 0, high)
            if not high:
                break
            size = self.sizes[high - 1]
            filled += size * min(self.counts[size], (room - filled) // size)
            high -= 1
        return filled


def pack_block(
    sizes: list[int], capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD,
    attention: int = ATTENTION,
) -> list[tuple[int, list[int]]]:
    """(capacity, pieces in the order placed) of every bin; no size exceeds the largest."""
    capacities = sorted(capacities)
    remaining = _Remaining(sizes)
    room: list[tuple[int, int]] = []  # (free words, bin), sorted
    bins: list[list[int]] = []
    used: list[int] = []

    def for_a_word(capacity: int, size: int) -> tuple[float, int]:
        held = size + remaining.filling(capacity - size)
        # What is never filled shrinks away in the end.
        fit = capacities[bisect.bisect_left(capacities, held)]
        return cost(fit, overhead, attention) / max(1, held), capacity

    for piece in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        size = sizes[piece]
        remaining.take(size)
        at = bisect.bisect_left(room, (size, -1))
        if at < len(room):
            free, chosen = room.pop(at)
        else:
            free = min((c for c in capacities if c >= size), key=lambda c: for_a_word(c, size))
            chosen = len(bins)
            bins.append([])
            used.append(0)
        bins[chosen].append(piece)
        used[chosen] += size
        bisect.insort(room, (free - size, chosen))
    fit = [capacities[bisect.bisect_left(capacities, words)] for words in used]
    return list(zip(fit, bins))


def cut(text: str, most: int) -> list[str]:
    """``text`` in pieces of ``most`` words, the last one shorter; joined they are ``text``."""
    begins = [m.start() for k, m in enumerate(re.finditer(WORD, text)) if k and k % most == 0]
    return [text[a:b] for a, b in zip([0, *begins], [*begins, len(text)])]


def _bins(
    part: int, block: int, pieces: list[tuple], names: list[str], last: bool, capacities: tuple[int, ...],
    overhead: int, attention: int,
) -> pd.DataFrame:
    """The bins of a block; unless it is the ``last`` round, pieces of those that are
    not full as rows of their own, without a bin."""
    packed = pack_block([p[2] for p in pieces], capacities, overhead, attention)
    out = []
    for k, (capacity, own) in enumerate(packed):
        used = sum(pieces[i][2] for i in own)
        number = (last << 62) + (part << 40) + (block << 20) + k
        if last or used >= FULL * capacity:
            out.append((number, capacity, used, *([pieces[i][n] for i in own] for n in range(len(names) - 3))))
        else:
            out += [(None, None, None, *([v] for v in pieces[i])) for i in own]
    return pd.DataFrame(out, columns=names).astype({"bin": "Int64", "capacity": "Int32", "used": "Int32"})


def pack(
    docs: DataFrame,
    capacities: tuple[int, ...] = CAPACITIES,
    overhead: int = OVERHEAD,
    texts: bool = False,
    attention: int = ATTENTION,
) -> DataFrame:
    """One row per bin: its capacity, words used, and its pieces in order.

    A piece is ``sizes`` words of a document from word ``starts`` on. With
    ``texts`` the pieces' texts follow in ``texts``.
    """
    most = max(capacities)
    columns = [F.col("doc_id").cast("long"), word_count(F.col("text")).alias("size_")]
    if texts:
        columns.append(F.coalesce("text", F.lit("")).alias("text"))
    names = ["bin", "capacity", "used", "doc_ids", "starts", "sizes", *(["texts"] if texts else [])]
    schema = SCHEMA + (", texts array<string>" if texts else "")

    def pieces_of(row) -> list[tuple]:
        """A document's pieces."""
        size = row.size_
        doc_id = None if pd.isna(row.doc_id) else int(row.doc_id)
        own = [""]
        if texts:
            own = [row.text] if size <= most else cut(row.text, most)
        found = [(doc_id, k * most, min(most, size - k * most)) for k in range(max(1, -(-size // most)))]
        return [(*p, own[k]) for k, p in enumerate(found)] if texts else found

    def left_over(row) -> list[tuple]:
        """A piece of a bin that was taken apart."""
        doc_id = None if pd.isna(row.doc_id) else int(row.doc_id)
        piece = (doc_id, int(row.start), int(row.size_))
        return [(*piece, row.text) if texts else piece]

    def blocks(read, last: bool):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            pieces: list[tuple] = []
            words = block = part = 0
            for frame in frames:
                for row in frame.itertuples(index=False):
                    part = row.part
                    own = read(row)
                    pieces += own
                    words += sum(p[2] for p in own)
                    if len(pieces) >= BLOCK_PIECES or words >= BLOCK_WORDS:
                        yield _bins(part, block, pieces, names, last, capacities, overhead, attention)
                        pieces, words, block = [], 0, block + 1
            if pieces:
                yield _bins(part, block, pieces, names, last, capacities, overhead, attention)

        return run

    part = F.spark_partition_id().alias("part")
    first = materialized(
        docs.select(*columns, part).mapInPandas(blocks(pieces_of, False), schema), "packing"
    )
    single = [F.col("doc_ids")[0].alias("doc_id"), F.col("starts")[0].alias("start"), F.col("sizes")[0].alias("size_")]
    if texts:
        single.append(F.col("texts")[0].alias("text"))
    rest = first.filter("bin IS NULL").select(*single)
    count, words = rest.agg(F.count(F.lit(1)), F.coalesce(F.sum("size_"), F.lit(0))).first()
    tasks = max(1, -(-words // BLOCK_WORDS), -(-count // BLOCK_PIECES))
    # The order in which rows arrive must not matter.
    dealt = rest.repartition(tasks).sortWithinPartitions("doc_id", "start", "size_")
    again = dealt.select("*", part).mapInPandas(blocks(left_over, True), schema)
    return first.filter("bin IS NOT NULL").unionByName(again)
