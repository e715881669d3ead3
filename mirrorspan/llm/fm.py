"""Quality score by a factorisation machine.

A text's features are its distinct hashed words (equal shares of unit length),
standardised statistics of its structure, and a bucket of its length as metadata.
Every feature has a weight and a vector; the score adds all pairwise products of
vectors in linear time, as half the squared sum less the sum of squares.

Learning takes a bounded sample of the labelled documents (``ROWS`` of each label,
whole texts, the first by a hash of the id) to the driver; all texts are scored in
tasks.

Defined results: null and empty texts have no words and neutral statistics, and get
a score like others; a null id is held out only if the check sum of an empty text
says so; repeated rows are scored one by one; without any labels the score is 0.5
for all; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS = 3000
HASHED = 1 << 18
LENGTHS = 24
RANK = 8
EPOCHS = 20
BATCH_CHARS = 3_000_000

WORDS = re.compile(r"\w+")
STATISTICS = (
    "lower", "upper", "digit", "blank", "line", "stop", "mark", "other", "beyond_ascii",
    "letters_a_word", "words_a_line", "distinct_words", "distinct_lines", "distinct_starts",
    "longest_line", "alternation",
)
# Weights: hashed words, length buckets, statistics.
SIZE = HASHED + LENGTHS + len(STATISTICS)


def _classes() -> np.ndarray:
    """Class of every code point below 128; above all are one class."""
    table = np.full(129, 7, np.uint8)
    for c in range(128):
        s = chr(c)
        if s.islower():
            table[c] = 0
        elif s.isupper():
            table[c] = 1
        elif s.isdigit():
            table[c] = 2
        elif s == "\n":
            table[c] = 4
        elif s.isspace():
            table[c] = 3
        elif s in ".,;:?":
            table[c] = 5
        elif s in "!'\"()-":
            table[c] = 6
    table[128] = 8
    return table


CLASSES = _classes()


class Reader:
    """Turns texts into features, remembering the hashes of words it has met."""

    MOST = 400_000

    def __init__(self):
        self.known = _Hashes()

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashed words end to end, their number for each text, statistics)."""
        if len(self.known) > self.MOST:
            self.known.clear()
        n = len(texts)
        stats = np.zeros((n, len(STATISTICS)))
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
        size = np.fromiter(map(len, texts), np.int64, n)
        kind = CLASSES[np.minimum(codes, 128)]
        owner = np.repeat(np.arange(n), size)
        count = np.bincount(owner * 9 + kind, minlength=9 * n).reshape(n, 9)
        chars = np.maximum(size, 1)
        stats[:, :9] = count / chars[:, None]
        turns = (kind[1:] != kind[:-1]) & (owner[1:] == owner[:-1]) if n else np.zeros(0, bool)
        stats[:, 15] = np.bincount(owner[1:][turns], minlength=n) / chars
        sets = []
        for k, text in enumerate(texts):
            words, lines = WORDS.findall(text.lower()), text.split("\n")
            distinct = set(words)
            sets.append(distinct)
            stats[k, 9] = sum(map(len, distinct)) / max(1, len(distinct))
            stats[k, 10] = np.log1p(len(words) / len(lines))
            stats[k, 11] = len(distinct) / max(1, len(words))
            stats[k, 12] = len(set(lines)) / len(lines)
            stats[k, 13] = len({line[:12] for line in lines}) / len(lines)
            stats[k, 14] = np.log1p(max(map(len, lines)))
        sizes = np.fromiter(map(len, sets), np.int64, n)
        found = itertools.chain.from_iterable(sets)
        words = np.fromiter(map(self.known.__getitem__, found), np.int64, int(sizes.sum()))
        bucket = np.minimum(np.log2(size + 1).astype(np.int64), LENGTHS - 1)
        return words, sizes, np.column_stack([bucket, stats])


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        self[word] = h = zlib.crc32(word.encode("utf-8", "replace")) % HASHED
        return h


@dataclass
class Model:
    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    mean: np.ndarray
    deviation: np.ndarray

    def features(self, read: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(feature, value, text) of all features."""
        words, sizes, rest = read
        n = len(sizes)
        owner = np.repeat(np.arange(n), sizes)
        share = 1 / np.sqrt(np.maximum(sizes, 1))
        z = np.clip((rest[:, 1:] - self.mean) / self.deviation, -4, 4)
        s = len(STATISTICS)
        return (
            np.concatenate([
                words, HASHED + rest[:, 0].astype(np.int64),
                np.tile(np.arange(s) + HASHED + LENGTHS, n),
            ]),
            np.concatenate([share[owner], np.ones(n), z.ravel() / np.sqrt(s)]),
            np.concatenate([owner, np.arange(n), np.repeat(np.arange(n), s)]),
        )

    def forward(self, at: np.ndarray, x: np.ndarray, text: np.ndarray, n: int):
        """Log odds and the sums over features that their gradient needs."""
        v = self.vectors[at] * x[:, None]
        sums = np.stack(
            [np.bincount(text, v[:, f], minlength=n) for f in range(v.shape[1])], axis=1
        )
        squares = np.bincount(text, (v * v).sum(axis=1), minlength=n)
        linear = np.bincount(text, self.weights[at] * x, minlength=n)
        return self.bias + linear + ((sums * sums).sum(axis=1) - squares) / 2, sums, v

    def score(self, read: tuple) -> np.ndarray:
        n = len(read[1])
        z = self.forward(*self.features(read), n)[0]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(texts: list[str], labels: list[int], shift: float = 0.0, seed: int = 3) -> Model:
    """AdaGrad on the logistic loss over whole texts.

    ``shift`` is added to the log odds: what the sample's shares of the labels lack.
    """
    rng = np.random.default_rng(seed)
    model = Model(
        0.0, np.zeros(SIZE), rng.normal(0, 0.05, (SIZE, RANK)),
        np.zeros(len(STATISTICS)), np.ones(len(STATISTICS)),
    )
    if not texts:
        model.vectors[:] = 0
        return model
    reader = Reader()
    parts = [reader.read(texts[k : k + 256]) for k in range(0, len(texts), 256)]
    words = np.concatenate([p[0] for p in parts])
    sizes = np.concatenate([p[1] for p in parts])
    rest = np.concatenate([p[2] for p in parts])
    model.mean = rest[:, 1:].mean(axis=0)
    model.deviation = rest[:, 1:].std(axis=0) + 1e-3
    begin = np.cumsum(sizes) - sizes
    y = np.array(labels, float)
    sq_w, sq_v, sq_b = np.full(SIZE, 1e-2), np.full(SIZE, 1e-2), 1e-2
    for _ in range(EPOCHS):
        for own in np.array_split(rng.permutation(len(y)), max(1, len(y) // 64)):
            picked = np.concatenate([words[begin[k] : begin[k] + sizes[k]] for k in own])
            at, x, text = model.features((picked, sizes[own], rest[own]))
            z, sums, v = model.forward(at, x, text, len(own))
            g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[own]) / len(own)
            gx = g[text] * x
            touched, where = np.unique(at, return_inverse=True)
            grad_w = np.bincount(where, gx) + 1e-5 * model.weights[touched]
            pair = gx[:, None] * (sums[text] - v)
            grad_v = np.stack([np.bincount(where, pair[:, f]) for f in range(RANK)], axis=1)
            grad_v += 1e-5 * model.vectors[touched]
            sq_w[touched] += grad_w**2
            sq_v[touched] += (grad_v**2).mean(axis=1)
            sq_b += g.sum() ** 2
            model.weights[touched] -= 0.1 * grad_w / np.sqrt(sq_w[touched])
            model.vectors[touched] -= 0.05 * grad_v / np.sqrt(sq_v[touched])[:, None]
            model.bias -= 0.1 * g.sum() / sq_b**0.5
    model.bias += shift
    return model


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4 == 2


def training_sample(
    docs: DataFrame, labels: DataFrame, rows: int = ROWS
) -> tuple[list[str], list[int], float]:
    """Whole texts and labels of at most ``rows`` documents a label, none held out.

    Last, by how much the log odds of all labels exceed those of the sample.
    """
    known = (
        labels.filter(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = (
        known.filter("quality = 1").orderBy(*order).limit(rows)
        .unionByName(known.filter("quality = 0").orderBy(*order).limit(rows))
        .withColumnRenamed("doc_id", "label_id")
    )
    found = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))  # bounded rows
        .groupBy("doc_id", "quality")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))  # one text an id
        .toPandas()
        .sort_values("doc_id")
    )
    counts = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(
        F.count("*").alias("n")).collect()}
    good, junk = counts.get(1, 0), counts.get(0, 0)
    shift = 0.0
    if good and junk:
        shift = math.log(good / junk) - math.log(min(good, rows) / min(junk, rows))
    return found["text"].tolist(), found["quality"].tolist(), shift


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    slim = Model(
        model.bias, model.weights.astype(np.float32), model.vectors.astype(np.float32),
        model.mean, model.deviation,
    )
    shared = docs.sparkSession.sparkContext.broadcast(slim)  # SIZE * (RANK + 1) floats

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader()
        for frame in frames:
            ends = np.cumsum(frame["text"].str.len().to_numpy(np.int64)) // BATCH_CHARS
            for _, some in frame.groupby(ends, sort=False):
                scores = shared.value.score(reader.read(some["text"].tolist()))
                out = some[["doc_id", "held_out"]].copy()
                out["score"] = scores
                out["predicted"] = (scores >= threshold).astype(np.int32)
                yield out

    rows = docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(
        run, f"doc_id {id_type}, held_out boolean, score double, predicted int"
    )
