"""Byte-level BPE, collocations and periodic runs against plain computations."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from llm_fixtures import documents, no_docs, odd_docs  # noqa: F401

from mirrorspan.llm import bpe, collocations, runs
from mirrorspan.llm.queries import QUERIES

RANKS = "byte_bpe_multi_50k.tiktoken"


@pytest.fixture(scope="module")
def ranks():
    import public_tokenizers

    return str(public_tokenizers.path(RANKS))


@pytest.fixture(scope="module")
def reference_encoding(ranks):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding(
        "reference", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(ranks),
        special_tokens={},
    )


def digest(data):
    return hashlib.sha256(data).hexdigest()


# Byte-level BPE


def encoded(docs, ranks):
    rows = bpe.encode(docs, ranks).collect()
    return {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in rows}


def test_pattern_is_the_vocabularys():
    import public_tokenizers

    assert bpe.PATTERN == public_tokenizers.PATTERN


def test_splitter_equals_the_pattern():
    import regex

    pattern, split = regex.compile(bpe.PATTERN), bpe.Splitter(bpe.code_point_classes())
    pick = random.Random(3)
    letters = "ab'sStmdrevl  \n\t.,!é漢1٣_''́ x\r\x1c\x85 \U0001F600"
    for _ in range(4000):
        texts = ["".join(pick.choice(letters) for _ in range(pick.randrange(14))) for _ in range(4)]
        want = [pattern.findall(t) for t in texts]
        found, sizes = split(texts)
        assert found == [w for own in want for w in own]
        assert sizes.tolist() == [len(own) for own in want]


def test_new_code_points_are_what_the_library_takes_them_for(reference_encoding, spark, ranks):
    # Letters of Unicode versions that regex libraries know differently.
    texts = [f"ab{chr(c)}cd {chr(c)}x 1{chr(c)}2" for c in range(0x30000, 0x323B0, 7)]
    texts += [f"z{chr(c)}1{chr(c)} {chr(c)}" for c in range(0x80, 0x3000, 3)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert encoded(frame, ranks) == {
        k: reference_encoding.encode_ordinary(t) for k, t in enumerate(texts)}


def test_byte_bpe_query(spark, folder, documents, reference_encoding):  # noqa: F811
    rows = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op12_byte_bpe"](spark, folder).collect()}
    want = {}
    for doc_id, text in zip(documents.doc_id, documents.text):
        ids = reference_encoding.encode_ordinary(text)
        want[doc_id] = (len(ids), digest(np.array(ids, "<u4").tobytes()), digest(text.encode()))
    assert rows == want


def test_small_blocks_and_long_texts(spark, folder, documents, reference_encoding, ranks, monkeypatch):  # noqa: F811
    """Several blocks a partition, texts cut at blanks, ids sent back in several parts."""
    texts = documents.text.tolist()[:60] + ["x" * 3000, " ".join(documents.text.tolist()[60:90])]
    split = bpe.Splitter(bpe.code_point_classes())
    monkeypatch.setattr(bpe, "CHUNK", 500)
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 20_000)
    block = bpe._Block()
    block.add(list(range(len(texts))), texts, split)
    words = list(block.numbers)
    stream = np.concatenate(block.parts)
    assert "".join(words[k] for k in stream.tolist()) == "".join(texts)
    ids = [i for k in stream.tolist() for i in reference_encoding._encode_single_piece(words[k])]
    assert ids == [i for t in texts for i in reference_encoding.encode_ordinary(t)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert encoded(frame, ranks) == {
        k: reference_encoding.encode_ordinary(t) for k, t in enumerate(texts)}


def test_bpe_odd_rows(odd_docs, no_docs, ranks):  # noqa: F811
    decoded = bpe.decode(bpe.encode(odd_docs, ranks), ranks).collect()
    want = sorted((repr(r["doc_id"]), (r["text"] or "").encode()) for r in odd_docs.collect())
    assert sorted((repr(r["doc_id"]), bytes(r["decoded"])) for r in decoded) == want
    assert bpe.digests(bpe.decode(bpe.encode(no_docs, ranks), ranks)).collect() == []
    only_empty = odd_docs.filter("text is null or text = ''")
    assert encoded(only_empty, ranks) == {2: [], 3: []}


def test_another_order_is_refused():
    import pyarrow as pa

    ids = {"bucket": [0], "block": [0], "check": [1], "sizes": [b""], "ids": [b""]}
    stream = {"block": [0], "check": [1], "numbers": [b""], "order": [b""], "buckets": [1],
              "doc_ids": [[1]], "sizes": [[0]]}
    for other in ({"check": [2]}, {"buckets": [2]}):
        with pytest.raises(RuntimeError, match="another order"):
            bpe._assemble(pa.table(ids), pa.table({**stream, **other}))


def test_unknown_ids_are_refused(ranks):
    with pytest.raises(ValueError, match="vocabulary"):
        bpe._decode_ids(np.array([60_000]), ranks)


# Collocations


def plain_collocations(rows, least, top, share=100):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 6):
                for at in range(len(words) - size + 1):
                    counts[lang][tuple(words[at : at + size])] += 1
    out = []
    for lang, own in counts.items():
        known = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        dropped = {
            p[i : i + size]
            for p, a in known.items() for size in range(2, len(p)) for i in range(len(p) - size + 1)
            if 100 * a >= share * own[p[i : i + size]]
        }
        scored = []
        for p in known.keys() - dropped:
            a, n = own[p], totals[lang]
            score, k = min(
                (1000 * a * n // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))
            )
            scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]], n))
        for rank, (score, a, phrase, left, right, n) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


@pytest.mark.parametrize(
    "least, hot, top, share", [(100, 1 << 19, 2000, 100), (10, 100, 2000, 100), (6, 40, 7, 80)]
)
def test_collocations(spark, folder, documents, least, hot, top, share):  # noqa: F811
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = collocations.collocations(docs, least, top, share, hot_count=hot)
    want = plain_collocations(zip(documents.lang, documents.text), least, top, share)
    assert sorted(map(tuple, found.collect())) == want


def test_collocations_of_small_blocks(spark, folder, documents, monkeypatch):  # noqa: F811
    """Blocks cut and suffixes merged in rounds, as in large inputs."""
    table = np.array([[1, 2, 0], [1, 2, 0], [1, 2, 3]], np.uint32)
    rows, counts = collocations.merged(table, np.array([1, 2, 4]))
    assert sorted((*r, c) for r, c in zip(rows.tolist(), counts.tolist())) == [
        (1, 2, 0, 3), (1, 2, 3, 4)]
    stream = np.array([1, 2, 3, 0, 4, 0, 5, 6], np.uint32)
    whole = collocations.suffixes(stream, 0, len(stream), 3)
    parts = [collocations.suffixes(stream, k, min(8, k + 3), 3) for k in (0, 3, 6)]
    assert whole.tolist() == np.concatenate(parts).tolist() == [[1, 2, 3], [2, 3, 0], [5, 6, 0]]


def test_quicksort_counts_prefixes():
    pick = np.random.default_rng(1)
    table = pick.integers(1, 5, (3000, 5)).astype(np.uint32)
    for row in table:  # suffixes that end before
        row[pick.integers(2, 6) :] = 0
    want = collections.Counter(
        tuple(r[:k]) for r in table.tolist() for k in range(2, 6) if r[k - 1]
    )
    prefixes, sizes = collocations.prefix_counts(
        table, np.ones(len(table), np.int64), np.zeros(len(table), np.uint8), 30)
    assert {tuple(p.tolist()): s for p, s in zip(prefixes, sizes)} == {
        p: s for p, s in want.items() if s >= 30}
    hot = (table == 1).cumprod(axis=1).sum(axis=1).astype(np.uint8)
    prefixes, sizes = collocations.prefix_counts(table, np.ones(len(table), np.int64), hot, 30)
    assert {tuple(p.tolist()): s for p, s in zip(prefixes, sizes)} == {
        p: s for p, s in want.items() if s >= 30 or set(p) == {1}}


def test_collocations_odd_rows(spark, odd_docs, no_docs):  # noqa: F811
    want = plain_collocations([(r["lang"], r["text"]) for r in odd_docs.collect()], 2, 50)
    assert want and sorted(map(tuple, collocations.collocations(odd_docs, 2, 50).collect())) == want
    assert collocations.collocations(no_docs).collect() == []
    rows = [(1, "a\x01 b, A b. a B! b", None), (2, None, "en"), (2, "a b", "und"), (3, "x\ty X y", "en")]
    frame = spark.createDataFrame([(*r, "z", "z") for r in rows], "doc_id long, text string, lang string, n string, key string")
    got = sorted(map(tuple, collocations.collocations(frame, 2, 50).collect()))
    assert got == plain_collocations([(r[2], r[1]) for r in rows], 2, 50)
    assert [r[:4] for r in got] == [("en", 1, "x y", 2), ("und", 1, "a b", 3)]


# Periodic runs


def plain_runs(words, least=24, times=3):
    found = []
    for q in range(1, len(words) // times + 1):
        same = [a == b for a, b in zip(words, words[q:])] + [False]
        at = 0
        while at < len(words) - q:
            end = at
            while same[end]:
                end += 1
            length = end - at + q
            if end > at and length >= max(least, times * q):
                own = words[at : at + length]
                if not any(own[p:] == own[:-p] for p in range(1, q)):
                    found.append((at, length, q))
            at = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    pick = random.Random(11)
    n_found = 0
    for _ in range(1200):
        n, letters = pick.randrange(160), pick.choice([1, 2, 3, 6, 60])
        words = [pick.randrange(letters) for _ in range(n)]
        for _ in range(pick.randrange(4) if n else 0):
            at, q, end = pick.randrange(n), pick.randrange(1, 30), pick.randrange(n + 1)
            for i in range(at + q, end):
                words[i] = words[i - q]
        want = plain_runs(words)
        n_found += len(want)
        array = np.array(words, np.int64)
        assert list(map(tuple, runs.stretch_runs(array).tolist())) == want
        (own,) = runs._batch_runs(array, np.array([n]))
        assert list(map(tuple, own.tolist())) == want
    assert n_found > 300


def test_extensions_equal_plain_comparison():
    pick = random.Random(7)
    for _ in range(100):
        text = [pick.randrange(1, 4) for _ in range(pick.randrange(1, 60))] + [0]
        shared = runs.Extensions(text)
        pairs = [(a, b) for a in range(len(text)) for b in range(len(text)) if a != b]
        a, b = np.array(pairs).T
        want = []
        for i, j in pairs:
            k = 0
            while max(i, j) + k < len(text) and text[i + k] == text[j + k]:
                k += 1
            want.append(k)
        assert shared(a, b).tolist() == want
        order = sorted(range(len(text)), key=lambda i: text[i:])
        assert np.argsort(shared.rank).tolist() == order


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    order = runs.repeated_tail(doc_id, len(words))
    words = words if order is None else [words[k] for k in order]
    found = plain_runs(words)
    best = None
    for s, length, q in found:
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    return (
        len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
        digest("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()),
        digest(b" ".join(w for k, w in enumerate(words) if k not in gone)),
    )


def test_repeated_tail():
    for doc_id in range(400):
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, 90
        order = runs.repeated_tail(doc_id, n)
        assert (order is None) == (h % 10 != 0)
        if order is not None:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert order.tolist() == [i if i < a else a + (i - a) % p for i in range(n)]


def test_periodic_runs_query(spark, folder, documents):  # noqa: F811
    rows = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_periodic_runs"](spark, folder).collect()}
    short = [(i, t) for i, t in zip(documents.doc_id, documents.text) if len(t) < 6000]
    assert len(rows) == len(documents) and sum(r[0] > 0 for r in rows.values()) > 10
    for doc_id, text in short:
        assert rows[doc_id] == plain_row(doc_id, text)


def test_runs_odd_rows(spark, odd_docs, no_docs):  # noqa: F811
    found = runs.find(odd_docs).collect()
    assert len(found) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in found}
    assert (by_id[2]["n_words"], by_id[2]["runs"], bytes(by_id[2]["collapsed"])) == (0, [], b"")
    # word0 the word1 the ...: 977 words that repeat
    assert [tuple(r) for r in by_id[4]["runs"]] == [(0, 60_000, 1954)]
    assert len(bytes(by_id[4]["collapsed"]).split()) == 1954
    assert runs.digests(runs.find(no_docs)).collect() == []
    (row,) = runs.digests(runs.find(odd_docs.filter("doc_id = 3"))).collect()
    assert tuple(row) == (3, 0, None, None, None, None, digest(b""), digest(b""))
