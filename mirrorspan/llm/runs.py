"""Periodic runs of words, by suffix trees.

A run is a stretch of consecutive words with smallest period q, of ``LEAST`` words and
``TIMES`` periods or more, that neither neighbour extends. For a stretch of words:

1. Ukkonen's algorithm builds the suffix trees of the stretch and of its reversal.
2. An Euler tour of each, kept as the depth of the shallowest node between one leaf
   and the next, with a sparse table of minima answers in constant time how far two
   places agree: the depth of their leaves' lowest common ancestor.
3. The leaves' order gives the longest Lyndon word at every place, under the order of
   the words and under the opposite one: it ends at the next smaller (greater) suffix.
   Every run has such a word for a root.
4. Each root is extended in both directions by the two trees; long enough ones are
   the runs.

Trees are only built where a run can be: every sequence of ``GRAM`` words in a run
stands there again a period away, so stretches are cut at sequences that stand once in
the document, then in the stretch, until nothing changes. The cut loses no run and keeps
runs whole: a run's sequences all lie in one stretch.

Defined results: words are what stands between ASCII white space; a null text is an
empty one, with no words and no runs; repeated rows and rows of null or shared ids
each have a row; an empty table gives no rows; only ``doc_id`` and ``text`` are read.
A document is handled whole, in one task: memory grows with its longest stretch.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorspan.llm.blocks import Numbers, lists

LEAST = 24
TIMES = 3
# The most for which L words of period q hold each sequence twice: L >= 2 q + GRAM - 1.
GRAM = 1 + LEAST * (TIMES - 2) // TIMES
BATCH_BYTES = 2_000_000
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)

Edit = Callable[[int | None, int], np.ndarray | None]


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * _MIX[1]
    x = (x ^ x >> np.uint64(27)) * _MIX[2]
    return x ^ x >> np.uint64(31)


def suffix_tree(text: list[int]) -> tuple[list[int], list[int], dict[int, int], int]:
    """Ukkonen's suffix tree of ``text``, whose last symbol, 0, stands nowhere else.

    (first place of the edge into each node, place after it, children by
    ``node * size + symbol``, size). Node 0 is the root; leaves arise in the order of their suffixes.
    """
    n, size = len(text), max(text) + 1
    start, end, link = [0], [0], [0]
    edges: dict[int, int] = {}
    node = edge = length = waiting = 0
    for i, symbol in enumerate(text):
        waiting += 1
        last = 0  # an inner node that still lacks its suffix link
        while waiting:
            if not length:
                edge = i
            key = node * size + text[edge]
            child = edges.get(key)
            if child is None:
                edges[key] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                if last:
                    link[last] = node
                    last = 0
            else:
                begin = start[child]
                stop = end[child]
                span = (stop if stop <= i else i + 1) - begin
                if length >= span:
                    edge += span
                    length -= span
                    node = child
                    continue
                if text[begin + length] == symbol:
                    length += 1
                    if last:
                        link[last] = node
                    break
                inner = edges[key] = len(start)
                start.append(begin)
                end.append(begin + length)
                link.append(0)
                edges[inner * size + symbol] = inner + 1
                start.append(i)
                end.append(n)
                link.append(0)
                start[child] = begin + length
                edges[inner * size + text[begin + length]] = child
                if last:
                    link[last] = inner
                last = inner
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    return start, end, edges, size


class Extensions:
    """How many words two places of a text share from there on, in constant time."""

    def __init__(self, text: list[int]):
        start, end, edges, size = suffix_tree(text)
        n = len(text)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        nodes = np.fromiter(edges.values(), np.int64, len(edges))
        order = np.argsort(keys)  # by parent, then by symbol
        nodes, parents = nodes[order], keys[order] // size
        first = np.searchsorted(parents, np.arange(len(start) + 1)).tolist()
        children = nodes.tolist()
        # Tour: leaves in order and the node that it turns at between two of them.
        depth = [0] * len(start)
        leaves, turns = [], []
        waiting, turned = [(0, 0)], False
        while waiting:
            node, above = waiting.pop()
            if turned:
                turns.append(above)
                turned = False
            own = depth[node] = above + end[node] - start[node]
            low, high = first[node], first[node + 1]
            if low == high:
                leaves.append(n - own)
                turned = True
            else:
                waiting += [(child, own) for child in reversed(children[low:high])]
        self.rank = np.empty(n, np.int64)
        self.rank[leaves] = np.arange(n)
        self.minima = [np.array(turns, np.int32)]
        step = 1
        while 2 * step <= len(turns):
            below = self.minima[-1]
            self.minima.append(np.minimum(below[:-step], below[step:]))
            step *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of places ``a`` and ``b``, nowhere the same."""
        a, b = self.rank[a], self.rank[b]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp(high - low)[1] - 1
        shared = np.empty(len(low), np.int64)
        for k in np.unique(level).tolist():
            of = level == k
            row = self.minima[k]
            shared[of] = np.minimum(row[low[of]], row[high[of] - (1 << k)])
        return shared


def lyndon_ends(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the longest Lyndon word of each place ends, under both orders; -1 for none."""
    n = len(rank) - 1
    ranks = rank.tolist()
    smaller, greater = [0] * n, [-1] * n
    low, high = [n], []
    for i in range(n - 1, -1, -1):
        own = ranks[i]
        while ranks[low[-1]] > own:
            low.pop()
        smaller[i] = low[-1]
        low.append(i)
        while high and ranks[high[-1]] < own:
            high.pop()
        if high:
            greater[i] = high[-1]
        high.append(i)
    return np.array(smaller), np.array(greater)


def stretch_runs(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """(start, length, period) of the runs of a stretch of word numbers, by start and period."""
    n = len(words)
    if n < least:
        return np.zeros((0, 3), np.int64)
    text = (np.unique(words, return_inverse=True)[1] + 1).tolist()
    forward, backward = Extensions([*text, 0]), Extensions([*text[::-1], 0])
    smaller, greater = lyndon_ends(forward.rank)
    begin = np.concatenate([np.arange(n), np.flatnonzero(greater >= 0)])
    end = np.concatenate([smaller, greater[greater >= 0]])
    # Place i of the text is place n - 1 - i of its reversal.
    right = forward(begin, end)
    left = np.zeros(len(begin), np.int64)
    inside = begin > 0
    left[inside] = backward(n - begin[inside], n - end[inside])
    period = end - begin
    start, length = begin - left, end + right - begin + left
    kept = (length >= least) & (length >= times * period)
    found = np.stack([start[kept], length[kept], period[kept]], axis=1)
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def stretches(words: np.ndarray, owner: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of the stretches, within an owner, that can hold a run."""
    if len(words) < LEAST:
        return []
    value = np.zeros(len(words) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        value = _scramble(value * _MIX[0] + words[k : k + len(value)].astype(np.uint64) + np.uint64(1))
    places = np.flatnonzero(owner[: len(value)] == owner[GRAM - 1 :])
    of = owner[places].astype(np.uint64)
    while len(places):
        key = _scramble(value[places] ^ of * _MIX[0])
        order = np.argsort(key)
        own = key[order]
        again = np.zeros(len(own), bool)
        again[1:] = own[1:] == own[:-1]
        again[:-1] |= again[1:]
        kept = np.zeros(len(places), bool)
        kept[order] = again
        left, of = places[kept], of[kept]
        if not len(left):
            return []
        # Stretches of neighbouring places, of one stretch before.
        first = np.ones(len(left), bool)
        first[1:] = (np.diff(left) != 1) | (of[1:] != of[:-1])
        number = np.cumsum(first) - 1
        size = np.bincount(number)
        long = size >= LEAST - GRAM + 1
        if long.all() and len(left) == len(places):
            begins = left[first]
            return list(zip(begins.tolist(), (begins + size + GRAM - 1).tolist()))
        places, of = left[long[number]], number[long[number]].astype(np.uint64)
    return []


def _batch_runs(words: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The runs of every document; ``sizes`` are their numbers of words."""
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    found: list[list[np.ndarray]] = [[] for _ in sizes]
    for begin, end in stretches(words, owner):
        doc = int(owner[begin])
        runs = stretch_runs(words[begin:end])
        if len(runs):
            found[doc].append(runs + [begin - starts[doc], 0, 0])
    out = []
    for parts in found:
        own = np.concatenate(parts) if parts else np.zeros((0, 3), np.int64)
        out.append(own[np.lexsort((own[:, 2], own[:, 0]))])
    return out


def _rows(ids: list, texts: list[bytes], edit: Edit | None) -> pa.RecordBatch:
    numbers = Numbers()
    documents = [t.split() for t in texts]
    if edit is not None:
        orders = [edit(i, len(d)) for i, d in zip(ids, documents)]
        documents = [
            d if o is None else list(map(d.__getitem__, o.tolist()))
            for d, o in zip(documents, orders)
        ]
    sizes = np.fromiter(map(len, documents), np.int64, len(documents))
    flat = np.fromiter(
        (numbers[w] for d in documents for w in d), np.int64, int(sizes.sum())
    )
    runs = _batch_runs(flat, sizes)
    collapsed = []
    for words, own in zip(documents, runs):
        if len(own):
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, own[:, 0] + own[:, 2], 1)
            np.add.at(change, own[:, 0] + own[:, 1], -1)
            dropped = np.cumsum(change[:-1]) > 0
            words = [w for w, d in zip(words, dropped.tolist()) if not d]
        collapsed.append(b" ".join(words))
    every = np.concatenate(runs)
    struct = pa.StructArray.from_arrays(
        [pa.array(np.ascontiguousarray(every[:, k])) for k in range(3)], ["start", "length", "period"]
    )
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array(sizes),
            lists(np.fromiter(map(len, runs), np.int64, len(runs)), struct),
            pa.array(collapsed, pa.binary()),
        ],
        ["doc_id", "n_words", "runs", "collapsed"],
    )


SCHEMA = (
    "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
    "collapsed binary"
)


def find(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of ``docs``.

    runs: by start, then period; words are numbered from 0. collapsed: the text (UTF-8)
    without the words of any run beyond its first period, with single blanks.
    ``edit`` may give a document, by its id and number of words, other words to look at:
    the places to take them from.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            low = 0
            while low < len(ids):
                high, held, some = low, 0, []
                while high < len(ids) and held < BATCH_BYTES:
                    some.append(texts[high].as_py())
                    held += len(some[-1])
                    high += 1
                yield _rows(ids[low:high], some, edit)
                low = high

    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return source.mapInArrow(run, SCHEMA)


def repeated_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """For one id in ten, the text's words with a repeated stretch at the end."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    at = g % n
    period = 1 + (n - at) // (3 + g % 8)
    places = np.arange(n)
    places[at:] = at + (places[at:] - at) % period
    return places


def digests(found: DataFrame) -> DataFrame:
    """The run of the greatest exponent of each document, and digests of all it found."""

    def better(a: Column, b: Column) -> Column:
        """``b`` where its exponent is greater; runs come by start and period."""
        more = b["length"] * a["period"] > a["length"] * b["period"]
        return F.when(a.isNull() | more, b).otherwise(a)

    kind = "struct<start: long, length: long, period: long>"
    best = F.aggregate("runs", F.lit(None).cast(kind), better)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(
            F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(""),
            256,
        ).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
