"""Exact top-k inner products by a dual-tree search over cover trees.

The top level of the tree is shared: a few centres, chosen farthest first from a
bounded sample, divide all vectors into cells with a covering radius. A query's
worst kth score in the sample is a lower bound of its final one; only cells whose
bound, by centre and radius, reaches it are searched for that query.

Queries are gathered in large groups of bounded size and candidates in blocks of bounded
size within a cell; either has a cover tree, grown level by level: the centres of a level
are more than its scale apart, every point lies within the scale of one, the next level
halves the scale and has the centres of the one before among its own. The covering
radius is measured at each node. A group's tree is grown once and stored. The blocks of
cells that any group asks for are dealt out in shards; a task grows the trees of its
blocks once, and the groups pass by one after another, each with the worst kth scores
that the blocks before have left it, so queries travel once a shard and candidates once.

The search descends both trees together, for many nodes of the queries at a time, and
drops a pair of nodes if the product of the centres and the radii can't reach the worst
kth score of the queries below. It goes down while there are far fewer pairs of children
than of vectors below them. What remains is multiplied exactly. A last ranking per query
joins the tasks' results.

Components are floor(256 x), held in 16 bits where they fit, else in double precision.
Products are taken in single or double precision where that holds all of them exactly,
with whole numbers beyond it.

Defined results: vectors that are null, or hold a null, NaN or infinite component,
are neither queries nor candidates; only vectors of equal length are compared; a
query's own row is no candidate, another row with the same id is; ties go to the
smaller id (null last); a query with fewer than k candidates has that many rows; a
score that does not fit a long is an error; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mirrorspan.llm.common import materialized
from mirrorspan.session import local_frame

SAMPLE = 1024
CENTRES = 32
LEAF = 64
QUERY_LEAF = 8
QUERY_GROUP = 8192
# Candidates multiplied before bounds are looked at again, and queries at a time.
STEP, ROWS = 2048, 512
# Vectors that give a bound to queries without one.
SEEN = 256
# Points tried as centres at a time.
TRIED = 256
LEAST_BLOCK, MOST_BLOCK = 256, 4096
# A shard's vectors in memory, and the rows that make one worth a task.
SHARD_BYTES, LEAST_SHARD = 1 << 26, 4096
# Pairs of children worth looking at, to the pairs of vectors below them; so few of these
# are multiplied sooner than looked at.
WORTH, FEW = 0.0625, 1 << 15
EXACT, SINGLE = 2.0**53, 2.0**24
# An Arrow batch to a task, as a group of queries is one row.
BATCH_BYTES = 1 << 26


@dataclass
class Level:
    """The nodes of a scale. Node i has the i-th of the tree's centres."""

    scale: float
    radius: np.ndarray  # greatest distance of a point below
    norm: np.ndarray
    first: np.ndarray  # its children, or on the last level points, are order[first[i] : first[i + 1]]
    order: np.ndarray
    start: np.ndarray  # all points below are the tree's order[start[i] : start[i] + size[i]]
    size: np.ndarray

    def below(self, nodes: np.ndarray) -> np.ndarray:
        """Children (or points) of the nodes."""
        return self.order[_ranges(self.first[nodes], self.first[nodes + 1] - self.first[nodes])]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one after another."""
    ends = np.cumsum(sizes)
    if not len(ends):
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)


def _squares(x: np.ndarray) -> np.ndarray:
    return (x.astype(float, copy=False) ** 2).sum(axis=1)


def _narrow(x: np.ndarray) -> np.ndarray:
    """In single precision if it holds all products of two such matrices and their sums."""
    return x.astype(np.float32) if _squares(x).max(initial=0) < SINGLE else x


class CoverTree:
    """The cover tree of the rows of ``x``, at least one.

    ``centres`` are rows of ``x``; the first ``n`` of them make up a level of ``n`` nodes, so
    levels are nested. Levels end when no node has more than ``leaf`` points, or all points
    of a node are equal. In ``order`` the points below any node are neighbours.
    """

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x = x
        squares = _squares(x)
        most = 4 * squares.max()
        whole = most < EXACT and bool((x == np.floor(x)).all())
        fast = x if most < SINGLE else x.astype(float, copy=False)

        def apart(rows: np.ndarray | slice, centres: np.ndarray) -> np.ndarray:
            """Squared distances."""
            if whole:  # nothing is rounded
                own, other = squares[rows].astype(fast.dtype), squares[centres].astype(fast.dtype)
                return own[:, None] + other - 2 * (fast[rows] @ fast[centres].T)
            return np.stack([_squares(fast[rows] - fast[c]) for c in centres], axis=1)

        every = slice(None)
        gap = apart(every, np.zeros(1, int))[:, 0]
        centres, nearest = [0], np.zeros(len(x), np.int64)
        scale = float(2.0 ** np.ceil(np.log2(np.sqrt(gap.max())))) if gap.max() > 0 else 0.0
        scales, counts, owners = [scale], [1], [nearest.copy()]
        while (
            np.bincount(nearest, minlength=len(centres)).max() > leaf
            and gap.max() > 0 and np.isfinite(scale)
        ):
            scale /= 2
            while gap.max() > scale**2:  # the farthest points are centres of this level
                tried = np.flatnonzero(gap > scale**2)
                tried = tried[np.argsort(-gap[tried], kind="stable")[:TRIED]]
                close = apart(tried, tried) <= scale**2
                free = np.ones(len(tried), bool)
                for i in np.flatnonzero(close.sum(axis=1) > 1):  # unless near one chosen before
                    if free[i]:
                        free[i + 1 :] &= ~close[i, i + 1 :]
                tried = tried[free]
                far = apart(every, tried)
                which = far.argmin(axis=1)
                far = far[np.arange(len(x)), which]
                closer = far < gap
                nearest[closer], gap = len(centres) + which[closer], np.minimum(gap, far)
                centres += tried.tolist()
            if len(centres) > counts[-1]:
                scales.append(scale)
                counts.append(len(centres))
                owners.append(nearest.copy())
            else:  # nothing divides at this scale
                scales[-1] = scale
        self.centres = np.array(centres)
        # A centre's parent is the nearest centre of the level above; points follow theirs.
        own = owners[-1]
        norms, places, self.levels = np.sqrt(squares), [], []
        for depth in reversed(range(len(counts))):
            n = counts[depth]
            of = own if depth == len(counts) - 1 else owners[depth][self.centres[: counts[depth + 1]]]
            place = own if depth == len(counts) - 1 else of[place]
            places.append(place)
            radius = np.zeros(n)
            away = np.flatnonzero(self.centres[place] != np.arange(len(x)))
            if len(away):
                gaps = x[away].astype(float, copy=False) - x[self.centres[place[away]]]
                np.maximum.at(radius, place[away], np.linalg.norm(gaps, axis=1))
            order = np.argsort(of, kind="stable")
            first = np.searchsorted(of[order], np.arange(n + 1))
            size = np.bincount(place, minlength=n)
            norm = norms[self.centres[:n]]
            self.levels.insert(0, Level(scales[depth], radius, norm, first, order, size, size))
        self.order = np.lexsort(places)
        for level, place in zip(self.levels, reversed(places)):
            at = place[self.order]
            firsts = np.flatnonzero(np.diff(at, prepend=-1))
            level.start = np.zeros(len(level.size), np.int64)
            level.start[at[firsts]] = firsts

    def points(self, depth: int, nodes: int | np.ndarray) -> np.ndarray:
        """All points below a node, or below nodes one after another."""
        level, nodes = self.levels[depth], np.atleast_1d(nodes)
        return self.order[_ranges(level.start[nodes], level.size[nodes])]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and ``b``, floating only while they are whole."""
    if not a.shape[1]:
        return np.zeros((len(a), len(b)))
    if a.dtype == b.dtype == np.float32:
        return a @ b.T
    a, b = a.astype(float, copy=False), b.astype(float, copy=False)
    top = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if top < EXACT:
        return a @ b.T
    whole = np.array([[int(v) for v in r] for r in a], object).reshape(a.shape)
    other = np.array([[int(v) for v in r] for r in b], object).reshape(b.shape)
    return (whole @ other.T).astype(np.int64)  # raises if it doesn't fit


class Best:
    """The best ``k`` of each query so far, by score, then id (null last), then row."""

    def __init__(self, rows: np.ndarray, worst: np.ndarray, k: int):
        self.rows, self.worst, self.k = rows, worst.astype(float), k
        self.n = np.zeros(len(rows), np.int64)
        # score, id is null, id, row
        self.kept = [np.zeros((len(rows), k), t) for t in (np.int64, bool, np.int64, np.int64)]

    def add(self, q: np.ndarray, *hits: np.ndarray) -> None:
        who = np.unique(q)
        if not len(who):
            return
        rest, at = np.repeat(who, self.n[who]), _ranges(np.zeros(len(who), int), self.n[who])
        q = np.concatenate([rest, q])
        score, none, ids, row = (
            np.concatenate([own[rest, at], new]) for own, new in zip(self.kept, hits)
        )
        order = np.lexsort((row, ids, none, ~score, q))
        q = q[order]
        sizes = np.diff(np.append(np.flatnonzero(np.diff(q, prepend=-1)), len(q)))
        rank = _ranges(np.zeros(len(sizes), int), sizes)
        keep = rank < self.k
        for own, new in zip(self.kept, (score, none, ids, row)):
            own[q[keep], rank[keep]] = new[order[keep]]
        self.n[who] = np.minimum(sizes, self.k)
        full = who[sizes >= self.k]
        self.worst[full] = np.maximum(self.worst[full], self.kept[0][full, -1])


def descend(
    asked: CoverTree, best: Best, grown: CoverTree,
    ids: np.ndarray, none: np.ndarray, rows: np.ndarray, tally: Counter | None = None,
) -> None:
    """Betters ``best`` of the points of ``asked`` by those of ``grown`` that reach its worst.

    ``ids`` (null where ``none``) rank ties, ``rows`` tell a query's own row. ``tally`` counts
    pairs of nodes that were looked at and dropped, and pairs of vectors that were multiplied.
    """
    tally, k = Counter() if tally is None else tally, best.k

    def multiply(queries: np.ndarray, points: np.ndarray) -> None:
        tally["products"] += len(queries) * len(points)
        x = grown.x[points]
        for low in range(0, len(queries), ROWS):
            some = queries[low : low + ROWS]
            scores = _products(asked.x[some], x)
            least = best.worst[some]
            if scores.dtype == np.float32:
                least = np.clip(least, -SINGLE, SINGLE).astype(np.float32)
            hits = np.flatnonzero(scores >= least[:, None])
            if len(hits) > 4 * (k + 1) * len(some):  # its own row may be one of them
                among = np.partition(scores, -(k + 1), axis=1)[:, -(k + 1)]
                hits = np.flatnonzero(scores >= np.maximum(least, among)[:, None])
            q, p = np.divmod(hits, len(points))
            q, p, score = some[q], points[p], scores.ravel()[hits].astype(np.int64)
            other = rows[p] != best.rows[q]
            q, p, score = q[other], p[other], score[other]
            best.add(q, score, none[p], ids[p], rows[p])

    def least(depth: int, nodes: np.ndarray) -> np.ndarray:
        """The worst kth score of the queries below each node."""
        sizes = asked.levels[depth].size[nodes]
        worst = best.worst[asked.points(depth, nodes)]
        return np.minimum.reduceat(worst, np.cumsum(sizes) - sizes)

    def reach(depth: int, some: np.ndarray, down: int, nodes: np.ndarray) -> np.ndarray:
        """Bounds of the products below nodes of the queries and nodes of the vectors."""
        one, other = asked.levels[depth], grown.levels[down]
        a, b = asked.x[asked.centres[some]], grown.x[grown.centres[nodes]]
        if a.dtype != b.dtype:
            a, b = a.astype(float, copy=False), b.astype(float, copy=False)
        norm, far = one.norm[some][:, None], one.radius[some][:, None]
        whole = norm + far
        value = a @ b.T + whole * other.radius[nodes] + far * other.norm[nodes]
        return value + 1e-9 * whole * (other.norm[nodes] + other.radius[nodes])  # for rounding

    def meet(depth: int, some: np.ndarray, down: int, nodes: np.ndarray, bounds: np.ndarray) -> None:
        queries = asked.points(depth, some)
        queries = queries[best.worst[queries] < np.inf]
        order = np.argsort(-bounds.max(axis=0), kind="stable")
        nodes, bounds = nodes[order], bounds[:, order]
        while len(nodes):
            sizes = np.cumsum(grown.levels[down].size[nodes])
            end = max(1, int(np.searchsorted(sizes, STEP, side="right")))
            multiply(queries, grown.points(down, nodes[:end]))
            nodes, bounds = nodes[end:], bounds[:, end:]
            if len(nodes):
                kept = ~(bounds < least(depth, some)[:, None]).all(axis=0)
                tally["dropped"] += len(some) * int((~kept).sum())
                nodes, bounds = nodes[kept], bounds[:, kept]

    def go_on(depth: int, some: np.ndarray, down: int, nodes: np.ndarray, bounds: np.ndarray,
              kept: np.ndarray) -> None:
        """Takes up the pairs that are kept: nodes of the queries that want others go apart."""
        wanting, wanted = kept.any(axis=1), kept.any(axis=0)
        if not wanting.any():
            return
        some, nodes = some[wanting], nodes[wanted]
        bounds, kept = bounds[wanting][:, wanted], kept[wanting][:, wanted]
        one, other = asked.levels[depth], grown.levels[down]
        products = one.size[some].sum() * other.size[nodes].sum()
        if products <= FEW:
            meet(depth, some, down, nodes, bounds)
            return
        if len(some) > 1 and 2 * kept.sum() < kept.size:
            half = len(some) // 2
            for part in (slice(half, None), slice(half)):
                go_on(depth, some[part], down, nodes, bounds[part], kept[part])
            return
        steps = []
        if down < len(grown.levels) - 1:
            steps.append((other.radius[nodes].max(), 1, depth, down + 1))
        if depth < len(asked.levels) - 1:
            steps.append((one.radius[some].max(), 0, depth + 1, down))
        for _, of_vectors, deeper, lower in sorted(steps, reverse=True):
            parts = some if of_vectors else one.below(some)
            under = other.below(nodes) if of_vectors else nodes
            if len(parts) * len(under) <= WORTH * products:
                stack.append((deeper, parts, lower, under))
                return
        meet(depth, some, down, nodes, bounds)

    unbound = np.flatnonzero(best.worst == -np.inf)
    if len(unbound) and len(grown.x) > SEEN:
        seen = grown.order[:: len(grown.x) // SEEN]
        tally["products"] += len(unbound) * len(seen)
        for low in range(0, len(unbound), ROWS):
            some = unbound[low : low + ROWS]
            known = _products(asked.x[some], grown.x[seen]).astype(float)
            known[rows[seen] == best.rows[some, None]] = -np.inf
            if len(seen) >= k:
                best.worst[some] = np.partition(known, -k, axis=1)[:, -k]
    stack = [(0, np.zeros(1, int), 0, np.zeros(1, int))]
    while stack:
        depth, some, down, nodes = stack.pop()
        bounds = reach(depth, some, down, nodes)
        kept = ~(bounds < least(depth, some)[:, None])
        tally["pairs"] += kept.size
        tally["dropped"] += int((~kept).sum())
        go_on(depth, some, down, nodes, bounds, kept)


def search(
    queries: np.ndarray, query_rows: np.ndarray, worst: np.ndarray,
    x: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, tally: dict | None = None,
) -> list[list[tuple[int, float, int]]]:
    """For each query its best (score, id, row), at most ``k``, of those not below ``worst``.

    An infinite id stands for null.
    """
    best, counts = Best(query_rows, worst, k), Counter(pairs=0, dropped=0, products=0)
    if len(queries) and len(x):
        none = np.isinf(ids)
        descend(
            CoverTree(_narrow(queries), QUERY_LEAF), best, CoverTree(_narrow(x)),
            np.where(none, 0, ids).astype(np.int64), none, np.asarray(rows), counts,
        )
    if tally is not None:
        tally.update({c: tally.get(c, 0) + n for c, n in counts.items()})
    return [
        [
            (int(s), float("inf") if lacks else int(i), int(r))
            for s, lacks, i, r in zip(*(own[q, :n] for own in best.kept))
        ]
        for q, n in enumerate(best.n)
    ]


def whole_components(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """floor(256 x) of every component of the vectors that take part.

    As bytes: 16 bits a component where all of a batch's fit, else doubles.
    """
    for batch in batches:
        lists = batch.column("v")
        lost = ~np.isfinite(lists.values.to_numpy(zero_copy_only=False))  # a null is NaN
        lost, at = np.append(0, np.cumsum(lost)), lists.offsets.to_numpy()
        fine = (lost[at[1:]] == lost[at[:-1]]) & lists.is_valid().to_numpy(zero_copy_only=False)
        if not fine.all():
            batch = batch.filter(pa.array(fine))
            lists = batch.column("v")
            at = lists.offsets.to_numpy()
        with np.errstate(over="ignore"):
            v = np.floor(256 * lists.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]])
        kind = np.dtype("<i2" if np.abs(v).max(initial=0) < 2**15 else "<f8")
        at = at - at[0]
        data = pa.Array.from_buffers(pa.binary(), len(lists), [
            None, pa.py_buffer((at * kind.itemsize).astype(np.int32)), pa.py_buffer(v.astype(kind)),
        ])
        columns = [batch.column("vec_id"), batch.column("row"), pa.array(np.diff(at), pa.int32()), data]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "row", "size", "v"])


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, their vectors) of the packed vectors."""
    sizes, data = batch.column("size").to_numpy(), batch.column("v").cast(pa.large_binary())
    ends = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    raw = np.frombuffer(data.buffers()[2] or b"", np.uint8)
    width = np.diff(ends) // np.maximum(sizes, 1)
    for size, wide in np.unique(np.stack([sizes, width]), axis=1).T.tolist():
        at = np.flatnonzero((sizes == size) & (width == wide))
        if len(at) == len(sizes):
            own = raw[ends[0] : ends[-1]]
        else:
            own = raw[ends[at][:, None] + np.arange(size * wide)]
        own = np.ascontiguousarray(own).reshape(-1).view("<i2" if wide == 2 else "<f8")
        yield size, at, own.reshape(len(at), size).astype(float)


class _Level:
    """Centres and sample of one length of vectors."""

    def __init__(self, rows: np.ndarray, x: np.ndarray):
        self.rows, self.x = rows, x
        chosen = [0]
        near = np.linalg.norm(x - x[0], axis=1)
        while len(chosen) < CENTRES and near.max() > 0:
            chosen.append(int(np.argmax(near)))
            near = np.minimum(near, np.linalg.norm(x - x[chosen[-1]], axis=1))
        self.centres = x[chosen]

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for a vector whatever others it comes with."""
        own, other = _squares(x), _squares(self.centres)
        cell = np.zeros(len(x), np.int64)
        plain = 4 * np.maximum(own, other.max()) < EXACT  # nothing is rounded
        cell[plain] = (other - 2 * (x[plain] @ self.centres.T)).argmin(axis=1)
        if not plain.all():
            gaps = [np.linalg.norm(x[~plain] - c, axis=1) for c in self.centres]
            cell[~plain] = np.argmin(gaps, axis=0)
        return cell, np.linalg.norm(x - self.centres[cell], axis=1)


def _level(levels: dict[int, _Level], size: int) -> _Level:
    """Lengths that the sample lacks have one cell around the origin and no bound."""
    found = levels.get(size)
    return found or _Level(np.array([-1]), np.zeros((1, size)))


def _reaching(q: np.ndarray, worst: np.ndarray, centre: np.ndarray, far: float) -> np.ndarray:
    """Queries whose worst score a cell may reach."""
    norm = np.sqrt(_squares(q))
    bound = q @ centre + norm * far + 1e-9 * norm * (np.linalg.norm(centre) + far)
    return ~(bound < worst)


def _mixed(rows: np.ndarray) -> np.ndarray:
    """Rows dealt at random, the same way every time."""
    return (rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)


@dataclass
class _Block:
    size: int
    cell: int
    tree: CoverTree
    ids: np.ndarray
    none: np.ndarray
    rows: np.ndarray


def _blocks(held: list[pa.RecordBatch], cells: list[tuple[int, int]], k: int) -> list[_Block]:
    """The blocks of rows that come in the order of their block."""
    table = pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=None)
    out = []
    for whole in table:
        number = whole.column("block").to_numpy()
        firsts = np.flatnonzero(np.diff(number, prepend=-1))
        for low, high in zip(firsts, [*firsts[1:], len(number)]):
            batch = whole.slice(low, high - low)
            x = np.zeros((high - low, batch.column("size")[0].as_py()))
            for _, at, own in _matrices(batch):
                x[at] = own
            none = batch.column("vec_id").is_null().to_numpy(zero_copy_only=False)
            ids, rows = batch.column("vec_id").fill_null(0).to_numpy(), batch.column("row").to_numpy()
            # Of equal vectors only the first can be among the best of any query, and one its own.
            seen, some, x = Counter(), [], _narrow(x)
            for i in np.lexsort((rows, ids, none)).tolist():
                key = x[i].tobytes()
                seen[key] += 1
                if seen[key] <= k + 1:
                    some.append(i)
            size, cell = cells[number[low]]
            out.append(_Block(size, cell, CoverTree(x[some]), ids[some], none[some], rows[some]))
    return out


FOUND = "query_row long, query_id long, vec_id long, row long, score long"


def _found(best: Best, ids: np.ndarray) -> pa.RecordBatch:
    at = np.repeat(np.arange(len(ids)), best.n)
    score, none, found, row = (own[at, _ranges(0 * best.n, best.n)] for own in best.kept)
    columns = [best.rows[at], ids[at], pa.array(found, mask=none), row, score]
    return pa.RecordBatch.from_arrays(
        [pa.array(c) for c in columns], ["query_row", "query_id", "vec_id", "row", "score"]
    )


def _with_large_rows(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Materialized, with batches to Python bounded by bytes meanwhile."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        return materialized(df, label)
    finally:
        spark.conf.set(name, before)


def top_k(
    vectors: DataFrame, k: int = 5, every: int = 50, column: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the best ``k`` for each id divisible by ``every``."""
    spark = vectors.sparkSession
    packed = "vec_id long, row long, size int, v binary"
    base = materialized(
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col(column).cast("array<double>").alias("v"),
            F.monotonically_increasing_id().alias("row"),
        ).mapInArrow(whole_components, packed),
        "vectors",
    )
    drawn = base.orderBy(F.xxhash64("vec_id", "row"), "row").limit(SAMPLE).toArrow()
    levels: dict[int, _Level] = {}
    for batch in drawn.combine_chunks().to_batches():
        rows, own = batch.column("row").to_numpy(), {}
        for size, at, x in _matrices(batch):
            own.setdefault(size, []).append((at, x))
        for size, parts in own.items():
            at, x = (np.concatenate(p) for p in zip(*parts))
            levels[size] = _Level(rows[np.sort(at)], x[np.argsort(at)])

    def divide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            asks = ids % every == 0
            for size, at, x in _matrices(batch):
                cell, far = _level(levels, size).cells(x)
                most, here = np.zeros(cell.max() + 1), np.unique(cell)
                np.maximum.at(most, cell, far)
                n, asked = np.bincount(cell)[here], np.bincount(cell, asks[at])[here].astype(int)
                columns = [np.full(len(here), size), here, n, asked, most[here]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64()))],
                    ["size", "cell", "n", "asked", "far"],
                )

    # CENTRES rows for each length of vectors.
    stats = {
        (r["size"], r["cell"]): r
        for r in base.mapInArrow(divide, "size int, cell int, n long, asked long, far double")
        .groupBy("size", "cell")
        .agg(F.sum("n").alias("n"), F.sum("asked").alias("asked"), F.max("far").alias("far"))
        .orderBy("size", "cell").collect()
    }
    far = {c: r["far"] for c, r in stats.items()}

    # Cells next to each other share a group of queries while it has room.
    dealt: dict[tuple[int, int], tuple[int, int]] = {}
    room, last, groups = 0, None, 0
    for (size, cell), r in stats.items():
        n = r["asked"]
        if not n:
            continue
        if size == last and n <= room:
            dealt[size, cell], room = (groups - 1, 1), room - n
        else:
            parts = -(-n // QUERY_GROUP)
            dealt[size, cell] = groups, parts
            groups, last = groups + parts, size
            room = QUERY_GROUP - n if parts == 1 else 0
    result = "query_id long, rank int, vec_id long, score long"
    if not dealt:
        return local_frame(spark, [], result)

    def aim(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            group, worst = np.zeros(len(rows), np.int64), np.full(len(rows), -np.inf)
            for size, at, q in _matrices(batch):
                level = _level(levels, size)
                for low in range(0, len(at), ROWS):
                    some, own = at[low : low + ROWS], q[low : low + ROWS]
                    known = _products(own, level.x).astype(float)
                    known[(level.rows == rows[some, None]) | (level.rows < 0)] = -np.inf
                    if known.shape[1] >= k:
                        worst[some] = np.partition(known, -k, axis=1)[:, -k]
                cell = level.cells(q)[0]
                for c in np.unique(cell).tolist():
                    own = at[cell == c]
                    first, parts = dealt[size, c]
                    group[own] = first + _mixed(rows[own]) % np.uint64(parts)
            columns = [pa.array(group, pa.int32()), *batch.columns, pa.array(worst)]
            yield pa.RecordBatch.from_arrays(columns, ["group", *batch.schema.names, "worst"])

    def grow(table: pa.Table) -> pa.Table:
        """A group of queries: the cells it asks for, and its tree."""
        batch = table.combine_chunks().to_batches()[0]
        size = batch.column("size")[0].as_py()
        q, worst = np.zeros((len(table), size)), batch.column("worst").to_numpy()
        for _, at, own in _matrices(batch):
            q[at] = own
        centres = _level(levels, size).centres
        cells = [
            c for c in range(len(centres))
            if (size, c) in far and _reaching(q, worst, centres[c], far[size, c]).any()
        ]
        ids, rows = (batch.column(c).to_numpy() for c in ("vec_id", "row"))
        data = pickle.dumps((size, CoverTree(_narrow(q), QUERY_LEAF), ids, rows, worst))
        data = zstandard.ZstdCompressor(level=1).compress(data)
        return pa.table({
            "group": batch.column("group")[:1], "size": batch.column("size")[:1],
            "cells": pa.array([cells], pa.list_(pa.int32())), "v": pa.array([data], pa.binary()),
        })

    asking = materialized(
        base.filter(F.col("vec_id") % every == 0)
        .mapInArrow(aim, f"group int, {packed}, worst double")
        .groupBy("group")
        .applyInArrow(grow, "group int, size int, cells array<int>, v binary"),
        "vectors-queries",
    )
    # A row for each group.
    wants = {r["group"]: [(r["size"], c) for c in r["cells"]]
             for r in asking.select("group", "size", "cells").collect()}
    wanted = sorted({c for cells in wants.values() for c in cells})
    if not wanted:
        return local_frame(spark, [], result)

    # Queries travel once a shard, so shards cost no more than twice what candidates do.
    total, queries = sum(stats[c]["n"] for c in wanted), sum(r["asked"] for r in stats.values())
    weights = {c: 8 * c[0] + 64 for c in wanted}
    tasks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(
        1, -(-sum(stats[c]["n"] * w for c, w in weights.items()) // SHARD_BYTES),
        min(tasks, 2 * total // queries, -(-total // LEAST_SHARD)),
    )
    parts = max(1, min(len(wants), tasks // shards))
    block = min(MOST_BLOCK, max(LEAST_BLOCK, total // (8 * shards)))
    first, cells, loads = {}, [], []
    for c in wanted:
        n = -(-stats[c]["n"] // block)
        first[c] = len(cells), n
        cells += [c] * n
        loads += [stats[c]["n"] * weights[c] / n] * n
    # Blocks in order, so that a shard has few cells.
    middle = np.cumsum(loads) - np.array(loads) / 2
    shard = np.minimum((middle / sum(loads) * shards).astype(int), shards - 1)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            number = np.full(len(rows), -1)
            for size, at, x in _matrices(batch):
                cell = _level(levels, size).cells(x)[0]
                for c in np.unique(cell).tolist():
                    if (size, c) in first:
                        own = at[cell == c]
                        low, n = first[size, c]
                        number[own] = low + (_mixed(rows[own]) % np.uint64(n)).astype(int)
            batch = batch.filter(pa.array(number >= 0))
            number = number[number >= 0]
            columns = [pa.array(shard[number], pa.int32()), pa.array(number, pa.int32()), *batch.columns]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "block", *batch.schema.names])

    shards_of = {c: set(shard[low : low + n].tolist()) for c, (low, n) in first.items()}
    pairs = [
        (group, s * parts + group % parts)
        for group, own in wants.items() for s in sorted(set().union(*(shards_of[c] for c in own)))
    ]
    left = asking.join(
        F.broadcast(local_frame(spark, pairs, "group int, task int")), "group"
    ).select(
        "task", F.lit(1).alias("kind"), F.col("group").alias("block"),
        F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("long").alias("row"), "size", "v",
    )
    right = (
        base.mapInArrow(place, f"shard int, block int, {packed}")
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        .select(
            (F.col("shard") * parts + F.col("part")).alias("task"), F.lit(0).alias("kind"),
            "block", "vec_id", "row", "size", "v",
        )
    )
    centres = {size: _level(levels, size).centres for size, _ in wanted}

    def hunt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's candidates come first, by block, then groups of queries."""
        now, held, blocks = None, [], []
        for batch in batches:
            task, kind = batch.column("task").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero(np.diff(2 * task.astype(int) + kind)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(task)]):
                some = batch.slice(low, high - low)
                if not len(some):
                    continue
                if task[low] != now:
                    now, held, blocks = task[low], [], []
                if not kind[low]:
                    held.append(some)
                    continue
                if held:
                    blocks, held = _blocks(held, cells, k), []
                for data in some.column("v"):
                    data = zstandard.ZstdDecompressor().decompress(data.as_py())
                    size, tree, ids, rows, worst = pickle.loads(data)
                    best, q = Best(rows, worst, k), tree.x.astype(float)
                    for b in blocks:
                        if b.size != size:
                            continue
                        asks = _reaching(q, best.worst, centres[size][b.cell], far[size, b.cell])
                        if asks.any():
                            before = best.worst
                            best.worst = np.where(asks, before, np.inf)
                            descend(tree, best, b.tree, b.ids, b.none, b.rows)
                            best.worst = np.where(asks, best.worst, before)
                    yield _found(best, ids)

    met = _with_large_rows(
        spark,
        left.unionByName(right).repartitionById(shards * parts, "task")
        .sortWithinPartitions("task", "kind", "block").mapInArrow(hunt, FOUND),
        "vectors-found",
    )
    order = Window.partitionBy("query_row").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row"
    )
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
