"""Queries against their SQL, and against plain computations where there is none."""

import hashlib
import zlib

import pytest
from llm_fixtures import documents  # noqa: F401
from oracle import _bag, connect

from mirrorspan.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, folder, name):
    df = QUERIES[name](spark, folder)
    cursor = connect(folder).execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert _bag(df.columns, df.collect()) == _bag(names, cursor.fetchall())


def test_token_ids(spark, folder, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    import numpy as np

    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    start, want = 0, []
    for doc_id, text in sorted(zip(documents.doc_id, documents.text)):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, QUERIES["op3_token_ids"](spark, folder).collect())) == want


def test_spot_signatures(spark, folder, documents):
    from mirrorspan.llm import spotsigs

    rows = documents.sort_values("doc_id")
    ids, texts = rows.doc_id.tolist(), rows.text.tolist()
    got = {r["doc_id"]: r for r in QUERIES["op1_spot_signatures"](spark, folder).collect()}
    assert sorted(got) == ids
    spotter = spotsigs.Spotter()
    for k, (i, text) in enumerate(zip(ids, texts)):
        after = texts[(k + 1) % len(texts)]
        edited = spotsigs.edit(text, after)
        own, new, other = spotter.sets([text, edited, after])
        row = got[i]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (row["fingerprint"], row["edited_fingerprint"]) == (
            spotsigs.written(own), spotsigs.written(new))
        shared = len(set(own.tolist()) & set(new.tolist()))
        assert row["near_edited"] == shared / (len(own) + len(new) - shared)
        assert row["near_next"] == spotsigs.likeness(own, other)


@pytest.mark.parametrize(
    "name, label, threshold", [("op2_quality", "quality", 0.7), ("op7_toxic_spans", "toxic", 0.5)]
)
def test_held_out_accuracy(spark, name, label, threshold):
    folder = "/root/testdata/sf0.1"
    scores = QUERIES[name](spark, folder).select("doc_id", "held_out", "score", "predicted")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = scores.join(labels, "doc_id").filter("held_out").toPandas()
    assert ((rows.score >= threshold) == (rows.predicted == 1)).all()
    assert rows.score.between(0, 1).all()
    assert (rows.predicted == rows[label]).mean() > 0.97
    mod, rest = (4, 2) if label == "quality" else (5, 0)
    assert all(zlib.crc32(str(i).encode()) % mod == rest for i in rows.doc_id)


def test_pseudonyms_leave_clean_texts_alone(spark, folder, documents):
    texts = dict(zip(documents.doc_id, documents.text))
    rows = QUERIES["op6_pseudonyms"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        found = r["n_numbers"] + r["n_dates"] + r["n_others"]
        assert (r["text"] != texts[r["doc_id"]]) == (found > 0)


def test_packing_loses_no_word(spark, folder, documents):
    from mirrorspan.llm.packing import CAPACITIES

    words = {}
    for b in QUERIES["op10_best_fit"](spark, folder).collect():
        assert b["used"] == sum(b["sizes"]) <= b["capacity"] and b["capacity"] in CAPACITIES
        for i, start, size in zip(b["doc_ids"], b["starts"], b["sizes"]):
            words.setdefault(i, []).append((start, size))
    for i, text in zip(documents.doc_id, documents.text):
        at = 0
        for start, size in sorted(words[i]):
            assert start == at
            at += size
        assert at == len(text.split())
