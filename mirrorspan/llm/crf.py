"""Toxic spans by a linear-chain conditional random field.

Two states, clean and toxic, over the words of a text. A word's emission is the
sum of the weights of its hashed features (the word, its beginnings and ends, its
length); transitions are shared. Forward-backward marginals give every word its
probability of being toxic; a document's score is a logistic function of its
largest marginal and of the expected number of toxic words.

Labels are per document, so the words to learn from are labelled first: a word,
or a beginning of words, is toxic if it stands almost only in documents labelled
toxic, counted by distinct neighbourhoods so that copies of one document count
once, and by a likelihood ratio that chance doesn't reach. Words of clean
documents are clean.

Learning takes a bounded sample of the labelled documents (``TOXIC_ROWS`` and
``CLEAN_ROWS``, the first by a hash of the id) to the driver. Words are marked and the
calibration is fitted over their whole texts; the chain learns from windows of them,
``WINDOW`` words on both sides of each marked word and of three random ones a text. All
texts are scored whole, in tasks. The chain is computed exactly for texts of any length:
the 2x2 products of ``CHUNK`` words are formed for all chunks of a batch at once
and then joined along each document.

Defined results: null and empty texts, and texts without words, have no marginals
and get the base score of a text without toxic words; a null id is scored and held
out only if the check sum of an empty text says so; repeated rows are scored one
by one; without labels of both kinds, or words that tell them apart, the score is 0 for
all; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOXIC_ROWS = 1500
CLEAN_ROWS = 4500
FEATURES = 1 << 20
MASK = FEATURES - 1
CHUNK = 64
WINDOW = 10
EPOCHS = 4
# A marked word: likelihood ratio over chance, and its share within toxic texts.
LEAST_RATIO = 10.4
LEAST_SHARE = 0.9
# Parts by hash in which distinct neighbourhoods are counted.
PARTS = np.uint64(16)
BATCH_CHARS = 4_000_000

WORDS = re.compile(r"\w+")

SPANS = "array<struct<start:int,end:int>>"


def lowered(text: str) -> str:
    """``text`` in lower case, of the same length, so that offsets hold for both."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    return low


def words_of(text: str) -> list[str]:
    return WORDS.findall(lowered(text))


def features(word: str) -> list[int]:
    """Hashed features of a word: itself, its beginnings and ends, its length, a bias."""
    b, crc = word.encode("utf-8", "replace"), zlib.crc32
    return [
        crc(b) & MASK, crc(b[:3], 3) & MASK, crc(b[:4], 4) & MASK, crc(b[:5], 5) & MASK,
        crc(b[-3:], 13) & MASK, crc(b[-4:], 14) & MASK, min(len(b), 16), 17,
    ]


@dataclass
class Model:
    """Weights of the toxic state against the clean one, transitions, calibration.

    Before training nothing is toxic.
    """

    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES, np.float32))
    transitions: np.ndarray = field(default_factory=lambda: np.array([[0.0, -30.0]] * 2))
    start: float = -30.0
    calibration: tuple[float, float, float] = (-30.0, 0.0, 0.0)


def marginals(emissions: np.ndarray, sizes: np.ndarray, model: Model) -> np.ndarray:
    """P(toxic) of each word; ``sizes`` are the words of each text, laid end to end."""
    out = np.zeros(len(emissions))
    if not len(emissions):
        return out
    chunks = -(-sizes // CHUNK)
    first_chunk = np.cumsum(chunks) - chunks
    begin = np.cumsum(sizes) - sizes
    # Where each word stands: place within its chunk, chunk.
    within = np.arange(len(emissions)) - np.repeat(begin, sizes)
    column = np.repeat(first_chunk, sizes) + within // CHUNK
    row = within % CHUNK
    n = int(chunks.sum())
    real = np.zeros((CHUNK, n), bool)
    real[row, column] = True
    odds = np.ones((CHUNK, n))
    odds[row, column] = np.exp(np.clip(emissions, -25, 25))
    t = np.exp(model.transitions)
    opens = np.zeros(n, bool)
    opens[first_chunk[sizes > 0]] = True
    # A text's first word follows the start instead of another word.
    entry = np.array([1.0, np.exp(np.clip(model.start, -25, 25))])

    def step(a, b, k):
        """(a, b) after word k of every chunk, scaled to sum 1."""
        x, y = a * t[0, 0] + b * t[1, 0], a * t[0, 1] + b * t[1, 1]
        if k == 0:
            x, y = np.where(opens, a * entry[0], x), np.where(opens, b * entry[1], y)
        y = y * odds[k]
        return np.where(real[k], x, a), np.where(real[k], y, b)

    # 1. What a chunk makes of either state before it (rows scaled together).
    p = [np.ones(n), np.zeros(n), np.zeros(n), np.ones(n)]
    for k in range(CHUNK):
        p[0], p[1] = step(p[0], p[1], k)
        p[2], p[3] = step(p[2], p[3], k)
        scale = p[0] + p[1] + p[2] + p[3]
        p = [x / scale for x in p]
    # 2. Along each document: the state before each chunk, and what follows it.
    before = np.full((2, n), 0.5)
    after = np.full((2, n), 0.5)
    long = np.argsort(-chunks, kind="stable")
    for k in range(1, int(chunks.max())):
        own = first_chunk[long[: np.searchsorted(-chunks[long], -k)]] + k
        a, b = before[:, own - 1]
        x, y = a * p[0][own - 1] + b * p[2][own - 1], a * p[1][own - 1] + b * p[3][own - 1]
        before[:, own] = x / (x + y), y / (x + y)
    last = first_chunk + chunks - 1
    for k in range(1, int(chunks.max())):
        own = last[long[: np.searchsorted(-chunks[long], -k)]] - k
        a, b = after[:, own + 1]
        x, y = p[0][own + 1] * a + p[1][own + 1] * b, p[2][own + 1] * a + p[3][own + 1] * b
        after[:, own] = x / (x + y), y / (x + y)
    # 3. Forward within all chunks, then backward against it.
    a, b = before
    forward = np.empty((2, CHUNK, n))
    for k in range(CHUNK):
        a, b = step(a, b, k)
        scale = a + b
        a, b = a / scale, b / scale
        forward[0, k], forward[1, k] = a, b
    a, b = after
    share = np.empty((CHUNK, n))
    for k in range(CHUNK - 1, -1, -1):
        toxic = forward[1, k] * b
        share[k] = toxic / (toxic + forward[0, k] * a)
        # Chunks that open a text need nothing before their first word.
        x, y = t[0, 0] * a + t[0, 1] * odds[k] * b, t[1, 0] * a + t[1, 1] * odds[k] * b
        x, y = np.where(real[k], x, a), np.where(real[k], y, b)
        scale = x + y
        a, b = x / scale, y / scale
    return share[row, column]


class Corpus:
    """Training texts as numbers of distinct words: a list of strings would not fit."""

    def __init__(self, texts: list[str]):
        self.number: dict[str, int] = {}
        self.docs = [
            np.array([self.number.setdefault(w, len(self.number)) for w in words_of(t)], np.int32)
            for t in texts
        ]
        self.types = list(self.number)


def mark_words(corpus: Corpus, toxic: np.ndarray) -> list[np.ndarray]:
    """Which words of each document are taken as toxic."""
    types, docs = corpus.types, corpus.docs
    flat = np.concatenate(docs) if docs else np.zeros(0, np.int32)
    sizes = np.fromiter(map(len, docs), np.int64)
    label = np.repeat(toxic.astype(np.int32), sizes)
    mix = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
    # In place and by parts: these numbers of all words are the most that learning holds.
    near = np.roll(flat, 1).astype(np.uint64)
    near *= mix[0]
    after = np.roll(flat, -1).astype(np.uint64)
    after *= mix[1]
    near ^= after
    del after
    chance = max(1e-6, min(1 - 1e-6, label.mean() if len(label) else 0.5))

    def marked(group: np.ndarray, n: int) -> np.ndarray:
        """By the distinct neighbourhoods of each group in toxic and clean texts."""
        key = group * 2 + label
        pair = key.astype(np.uint64)
        pair *= mix[2]
        pair += near
        count = np.zeros(2 * n)
        for part in range(int(PARTS)):
            own = np.flatnonzero(pair % PARTS == np.uint64(part))
            first = np.unique(pair[own], return_index=True)[1]
            count += np.bincount(key[own[first]], minlength=2 * n)
        count = count.reshape(n, 2)
        total = np.maximum(count.sum(axis=1), 1)
        share = count[:, 1] / total
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.nan_to_num(count[:, 1] * np.log(share / chance))
            ratio += np.nan_to_num(count[:, 0] * np.log((1 - share) / (1 - chance)))
        return (share >= LEAST_SHARE) & (ratio >= LEAST_RATIO)

    chosen = marked(flat, len(types))[flat] if len(flat) else np.zeros(0, bool)
    for length in (4, 5, 6):
        heads: dict[str, int] = {}
        head = np.array([heads.setdefault(w[:length], len(heads)) for w in types], np.int32)
        # A beginning counts for words longer than itself.
        longer = np.array([len(w) > length for w in types], bool)
        if len(flat):
            chosen |= marked(head[flat], len(heads))[head[flat]] & longer[flat]
    chosen &= label == 1
    return np.split(chosen, np.cumsum(sizes)[:-1]) if docs else []


def _train_chain(model: Model, corpus: Corpus, marks: list[np.ndarray], seed: int) -> None:
    """Gradient ascent of the likelihood of the marks over windows of the texts."""
    rng = np.random.default_rng(seed)
    side = 2 * WINDOW + 1
    windows = []
    for d, m in enumerate(marks):
        centres = np.flatnonzero(m)
        others = rng.integers(0, max(1, len(m)), 3)
        windows += [(d, int(c)) for c in (*centres, *others) if len(m)]
    if not windows:
        return
    # Features are numbered among the words' own, and the padding's, before they are laid
    # out: sorting the windows' would take several times their memory.
    table = np.fromiter(
        itertools.chain.from_iterable(map(features, corpus.types)), np.int32, 8 * len(corpus.types)
    )
    used = np.union1d(table, 0)
    table = np.searchsorted(used, table).astype(np.int32).reshape(-1, 8)
    x = np.full((len(windows), side, 8), np.searchsorted(used, 0), np.int32)
    y = np.zeros((len(windows), side), np.int8)
    n = np.zeros(len(windows), np.int64)
    for i, (d, c) in enumerate(windows):
        low, high = max(0, c - WINDOW), c + WINDOW + 1
        own = corpus.docs[d][low:high]
        n[i] = len(own)
        x[i, : len(own)] = table[own]
        y[i, : len(own)] = marks[d][low:high]
    weights, squares = np.zeros(len(used)), np.full(len(used), 1e-2)
    trans, trans_sq = np.zeros((2, 2)), np.full((2, 2), 1e-2)
    start, start_sq = 0.0, 1e-2
    batch = min(256, max(16, len(windows) // 40))
    for _ in range(EPOCHS):
        for own in np.array_split(rng.permutation(len(windows)), -(-len(windows) // batch)):
            xb, yb, nb = x[own], y[own], n[own]
            mask = np.arange(side) < nb[:, None]
            e = weights[xb].sum(axis=2) * mask
            gap, pair, first = _expected(e, mask, trans, start)
            g = (yb - gap) * mask / len(own)
            touched, at = np.unique(xb, return_inverse=True)
            grad = np.bincount(at.ravel(), np.repeat(g.ravel(), 8))
            squares[touched] += grad**2
            weights[touched] += 0.3 * grad / np.sqrt(squares[touched])
            seen = np.zeros((2, 2))
            both = mask[:, 1:]
            np.add.at(seen, (yb[:, :-1][both], yb[:, 1:][both]), 1)
            grad_t = (seen - pair) / len(own)
            trans_sq += grad_t**2
            trans += 0.1 * grad_t / np.sqrt(trans_sq)
            grad_s = float((yb[:, 0] - first).mean())
            start_sq += grad_s**2
            start += 0.1 * grad_s / start_sq**0.5
    model.weights[used] = weights
    model.transitions, model.start = trans, start


def _expected(e: np.ndarray, mask: np.ndarray, trans: np.ndarray, start: float):
    """Marginals, expected transitions and first states of padded windows."""
    size, side = e.shape
    t = np.exp(trans)
    odds = np.exp(np.clip(e, -25, 25))
    forward = np.empty((side, 2, size))
    a, b = np.ones(size), np.exp(start) * odds[:, 0]
    forward[0] = np.stack([a, b]) / (a + b)
    for k in range(1, side):
        a, b = forward[k - 1]
        x, y = a * t[0, 0] + b * t[1, 0], (a * t[0, 1] + b * t[1, 1]) * odds[:, k]
        forward[k] = np.where(mask[:, k], np.stack([x, y]) / (x + y), forward[k - 1])
    back = np.full((2, size), 0.5)
    gap, pair = np.empty((size, side)), np.zeros((2, 2))
    for k in range(side - 1, -1, -1):
        both = forward[k] * back
        gap[:, k] = both[1] / both.sum(axis=0)
        if k:
            out = np.stack([back[0], back[1] * odds[:, k]])
            joint = forward[k - 1][:, None, :] * t[:, :, None] * out[None]
            joint /= joint.sum(axis=(0, 1))
            pair += (joint * mask[:, k]).sum(axis=2)
            new = t[:, :, None] * out[None]
            new = new.sum(axis=1)
            back = np.where(mask[:, k], new / new.sum(axis=0), back)
    return gap, pair, gap[:, 0]


def _signals(share: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per text: largest marginal as log odds, expected toxic words (of the likely ones)."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    most = np.zeros(len(sizes))
    np.maximum.at(most, owner, share)
    likely = np.bincount(owner, np.where(share >= 0.5, share, 0.0), minlength=len(sizes))
    most = np.clip(most, 1e-6, 1 - 1e-6)
    return np.stack([np.log(most / (1 - most)), np.log1p(likely)], axis=1)


class _Emissions(dict):
    """Emission of every word met so far."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        self[word] = e = float(self.weights[features(word)].sum())
        return e


class Scorer:
    """Scores batches of texts, remembering the emissions of words it has met."""

    MOST = 400_000

    def __init__(self, model: Model):
        self.model = model
        self.known = _Emissions(model.weights)

    def marginals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > self.MOST:
            self.known.clear()
        docs = [words_of(t) for t in texts]
        sizes = np.fromiter(map(len, docs), np.int64, len(docs))
        words = itertools.chain.from_iterable(docs)
        flat = np.fromiter(map(self.known.__getitem__, words), np.float64, int(sizes.sum()))
        return marginals(flat, sizes, self.model), sizes

    def score(self, texts: list[str]) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
        """Score and offending (start, end) offsets of every text."""
        share, sizes = self.marginals(texts)
        signals = _signals(share, sizes)
        base, top, count = self.model.calibration
        z = base + top * signals[:, 0] + count * signals[:, 1]
        scores = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        begin = np.cumsum(sizes) - sizes
        for d in np.flatnonzero(signals[:, 0] >= 0):
            own = share[begin[d] : begin[d] + sizes[d]] >= 0.5
            spans[d] = _spans(texts[d], own)
        return scores, spans


def _spans(text: str, toxic: np.ndarray) -> list[tuple[int, int]]:
    """Offsets of runs of toxic words."""
    found = [m.span() for m in WORDS.finditer(lowered(text))]
    out: list[tuple[int, int]] = []
    last = -2
    for k in np.flatnonzero(toxic):
        if k == last + 1:
            out[-1] = (out[-1][0], found[k][1])
        else:
            out.append(found[k])
        last = k
    return out


def _calibrated(x: np.ndarray, label: np.ndarray, shift: float) -> tuple[float, float, float]:
    """Logistic regression on the two signals, neither of which may speak against toxicity.

    The penalty keeps separable labels finite, and the base near the share of toxic texts
    where nothing else tells. ``shift`` undoes the sample's share of labels.
    """
    x = np.column_stack([np.ones(len(x)), x])
    share = (label.sum() + 0.5) / (len(label) + 1)
    prior = np.array([np.log(share / (1 - share)), 0.0, 0.0])
    weight = np.array([1e-2, 1e-1, 1e-1])
    free = [0, 1, 2]
    while True:
        w = np.where(np.isin(range(3), free), prior, 0.0)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = (x.T @ (label - p) - weight * (w - prior))[free]
            own = x[:, free]
            step = np.linalg.solve(
                (own * (p * (1 - p))[:, None]).T @ own + np.diag(weight[free]), grad
            )
            w[free] += step
        negative = [k for k in free[1:] if w[k] < 0]
        if not negative:
            return float(w[0] + shift), float(w[1]), float(w[2])
        free = [k for k in free if k not in negative]


def train(texts: list[str], toxic: list[int], shift: float = 0.0, seed: int = 7) -> Model:
    """A model from whole texts with document labels.

    ``shift`` is what the log odds of a toxic label are higher by in the corpus than in the
    sample. With labels of one kind only, or no word that tells toxic texts from others, the
    model finds nothing toxic: all scores are 0.
    """
    model = Model()
    label = np.array(toxic, dtype=bool)
    if label.all() or not label.any():
        return model
    corpus = Corpus(texts)
    marks = mark_words(corpus, label)
    if not any(m.any() for m in marks):
        return model
    _train_chain(model, corpus, marks, seed)
    del corpus, marks
    scorer = Scorer(model)

    def signals(own: list[str]) -> np.ndarray:
        return np.concatenate([
            _signals(*scorer.marginals(own[k : k + 256])) for k in range(0, len(own), 256)
        ])

    x = np.column_stack([np.ones(len(texts)), signals(texts)])
    # Logistic regression by Newton steps; the penalty keeps separable labels finite.
    w, penalty = np.zeros(3), np.diag([1e-3, 1e-1, 1e-1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (label - p) - penalty @ w
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, grad)
    model.calibration = tuple(map(float, w))
    if min(w[1:]) < 0:
        # Copies turn the scale: each text counts once for each label, no signal speaks
        # against toxicity, and the corpus's share of labels sets the base.
        single = sorted({(t, bool(y)) for t, y in zip(texts, label.tolist())})
        own = np.array([y for _, y in single])
        model.calibration = _calibrated(signals([t for t, _ in single]), own, shift)
    return model


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def training_sample(
    docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS
) -> tuple[list[str], list[int], float]:
    """Whole texts and labels of at most the given rows, none of them held out, and by how
    much the log odds of a toxic label are higher among all labels than in the sample."""
    known = (
        labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = (
        known.filter("toxic = 1").orderBy(*order).limit(toxic_rows)
        .unionByName(known.filter("toxic = 0").orderBy(*order).limit(clean_rows))
        .withColumnRenamed("doc_id", "label_id")
    )
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))  # bounded rows
        .groupBy("doc_id", "toxic")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))  # one text an id
        .toPandas()
        .sort_values("doc_id")
    )
    toxic = int(rows["toxic"].sum())
    clean_ = len(rows) - toxic
    counts = known.filter("toxic IS NOT NULL").agg(
        F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)
    ).first()
    shift = 0.0
    if toxic and clean_ and all(counts):
        shift = float(np.log(counts[0] / counts[1]) - np.log(toxic / clean_))
    return rows["text"].tolist(), rows["toxic"].tolist(), shift


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted, spans) of every row of ``docs``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for frame in frames:
            ends = np.cumsum(frame["text"].str.len().to_numpy(np.int64)) // BATCH_CHARS
            for _, some in frame.groupby(ends, sort=False):
                scores, spans = scorer.score(some["text"].tolist())
                out = some[["doc_id", "held_out"]].copy()
                out["score"] = scores
                out["predicted"] = (scores >= 0.5).astype(np.int32)
                out["spans"] = [[{"start": a, "end": b} for a, b in own] for own in spans]
                yield out

    rows = docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(
        run, f"doc_id {id_type}, held_out boolean, score double, predicted int, spans {SPANS}"
    )


def clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, unchanged."""

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for own in texts:
            ends = np.cumsum(own.str.len().to_numpy(np.int64)) // BATCH_CHARS
            parts = [scorer.score(some.tolist())[0] for _, some in own.groupby(ends, sort=False)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    scored = F.pandas_udf(run, "double")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return (
        docs.select(
            F.struct(*columns).alias("doc"),
            scored(F.coalesce(F.col("text"), F.lit(""))).alias("score"),
        )
        .filter(F.col("score") < threshold)
        .select("doc.*")
    )
