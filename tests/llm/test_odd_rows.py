"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import pytest
from llm_fixtures import no_docs, odd_docs  # noqa: F401

from mirrorspan.llm import bitpack, crf, dualtree, feistel, fm, licenses, minhash, mixing
from mirrorspan.llm import packing, spotsigs


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_spotsigs(odd_docs, no_docs):
    rows = spotsigs.edited(odd_docs).collect()
    assert len(rows) == 12
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["fingerprint"] == by_id[1]["fingerprint"] and by_id[0]["near_next"] == 1.0
    assert by_id[2]["n_chars"] == by_id[3]["n_chars"] == 0
    assert by_id[2]["near_next"] == 1.0 and by_id[3]["near_next"] == 0.0
    assert spotsigs.edited(no_docs).collect() == []
    members, pairs = spotsigs.similar(spotsigs.fingerprints(odd_docs))
    assert members.count() >= 12 and pairs.filter("likeness < 0.8").count() == 0


def test_single_document_follows_itself(spark):
    one = spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")
    (row,) = spotsigs.edited(one).collect()
    import hashlib

    assert row["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()


def test_similar_finds_all_pairs(spark):
    sets = [(k, sorted({(k // 3) * 100 + j for j in range(20 + k % 3)})) for k in range(60)]
    sets += [(1000 + k, list(range(5000, 5000 + n))) for k, n in enumerate((5, 6, 7, 8, 9, 10))]
    frame = spark.createDataFrame(sets, "doc_id long, signatures array<long>")
    _, pairs = spotsigs.similar(frame)
    want = {
        (a, b) for a, x in sets for b, y in sets
        if a < b and len({*x} & {*y}) / len({*x} | {*y}) >= 0.8
    }
    assert {(r["class_id"], r["other_id"]) for r in pairs.collect()} == want


@pytest.mark.parametrize("module", [fm, crf])
def test_scores(odd_docs, no_docs, module):
    texts = ["bad stupid words here"] * 5 + [f"good words number {k}" for k in range(20)]
    model = module.train(texts, [1] * 5 + [0] * 20)
    rows = module.score(odd_docs, model).collect()
    assert len(rows) == 12 and all(0 <= r["score"] <= 1 for r in rows)
    scores = {r["doc_id"]: r["score"] for r in rows}
    assert scores[2] == scores[3]  # null is empty
    assert module.score(no_docs, model).collect() == []
    assert len(module.score(odd_docs, module.train([], [])).collect()) == 12


def test_training_samples_without_labels(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert crf.training_sample(odd_docs, none) == ([], [], 0.0)
    assert fm.training_sample(odd_docs, none) == ([], [], 0.0)


def test_clean_keeps_columns(odd_docs):
    model = crf.train([], [])
    assert sorted(rows_of(crf.clean(odd_docs, model)), key=repr) == sorted(
        rows_of(odd_docs), key=repr)


def test_token_ids(spark, odd_docs, no_docs, tmp_path):
    import public_tokenizers

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    shards = bitpack.write_shards(odd_docs, str(tmp_path / "a"), path, 1, 49_408)
    rows = bitpack.read_shards(shards, str(tmp_path / "a")).collect()
    assert len(rows) == 12
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])][:3] == [None, None, 0]
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (2, 3)} == {1}
    shards = bitpack.write_shards(no_docs, str(tmp_path / "b"), path, 1, 49_408)
    assert bitpack.read_shards(shards, str(tmp_path / "b")).collect() == []


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (0, [1.0, 0.0]), (50, [0.5, 0.5]), (50, [0.5, 0.5]), (3, [1.0, 0.0]), (2, [1.0, 0.0]),
        (None, [1.0, 0.0]), (7, None), (100, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, None]),
        (150, [1.0]), (11, [2.0]), (200, []),
    ]
    frame = spark.createDataFrame(
        [(i, v, "x", 1) for i, v in vectors],
        "vec_id long, embedding array<double>, v string, cell int",
    )
    rows = dualtree.top_k(frame).orderBy("query_id", "rank").collect()
    own = [(r["vec_id"], r["score"]) for r in rows if r["query_id"] == 0]
    assert own == [(2, 65536), (3, 65536), (None, 65536), (50, 32768), (50, 32768)]
    assert [(r["vec_id"], r["score"]) for r in rows if r["query_id"] == 150] == [(11, 131072)]
    assert sum(r["query_id"] == 50 for r in rows) == 10
    assert not any(r["query_id"] in (100, 200) for r in rows)
    assert dualtree.top_k(frame.limit(0)).collect() == []


def test_licenses(odd_docs, no_docs):
    rows = licenses.summary(licenses.scan(odd_docs)).collect()
    assert len(rows) == 12
    for r in rows:
        if r["doc_id"] == 8:
            assert r["base_labels"] == "gpl" and r["labels"] == "gpl,gpl-3.0"
            assert (r["n_base"], r["first_word"], r["last_word"]) == (1, 4, 4)
        else:
            assert r["labels"] == "" and r["score"] == 0.0 and r["first_word"] is None
    assert {r["n_words"] for r in rows if r["doc_id"] in (2, 3, 5)} == {0}
    assert licenses.summary(licenses.scan(no_docs)).collect() == []


def test_pseudonyms(odd_docs, no_docs):
    out = feistel.replaced(odd_docs, b"k")
    assert out.columns == odd_docs.columns
    before = {(r["doc_id"], r["lang"]): r["text"] for r in odd_docs.collect() if r["doc_id"] != 8}
    rows = out.collect()
    assert len(rows) == 12
    for r in rows:
        if r["doc_id"] == 8:
            assert "a.b@x.org" not in r["text"] and "version 3" in r["text"]
        elif r["doc_id"] is not None:
            assert r["text"] == before[r["doc_id"], r["lang"]]
    assert len({r["text"] for r in rows if r["doc_id"] == 8}) == 1
    assert feistel.replaced(no_docs, b"k").collect() == []


def test_near_duplicates(odd_docs, no_docs):
    rows = minhash.near_duplicates(odd_docs).collect()
    assert len(rows) == 12
    classes = {r["doc_id"]: r["class_id"] for r in rows if r["doc_id"] is not None}
    assert classes == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 2, 6: 6, 7: 7, 8: 8}
    kept = minhash.distinct(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [0, 2, 4, 6, 7, 8]
    assert minhash.near_duplicates(no_docs).collect() == []
    assert minhash.distinct(no_docs).collect() == []


def test_near_duplicates_of_null_and_shared_ids(spark, odd_docs):
    nulls = [r["text"] for r in minhash.distinct(odd_docs).collect() if r["doc_id"] is None]
    assert sorted(nulls) == sorted(r["text"] for r in odd_docs.collect() if r["doc_id"] is None)
    texts = {c: " ".join(f"{c}{k}" for k in range(60)) for c in "abcd"}
    near = texts["d"].replace("d59", "other")
    docs = [
        (None, texts["a"]), (None, texts["b"]), (5, texts["a"]), (None, texts["b"].upper()),
        (7, texts["c"]), (7, texts["d"]), (7, texts["d"]), (9, near), (None, near),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(rows_of(minhash.near_duplicates(frame)), key=repr)
    assert got == sorted(
        [(None, 5), (None, None), (5, 5), (None, None), (7, 7), (7, 7), (7, 7), (9, 7), (None, 7)],
        key=repr)
    kept = sorted(((i, t.lower()) for i, t in rows_of(minhash.distinct(frame))), key=repr)
    assert kept == sorted(
        [(None, texts["b"]), (5, texts["a"]), (7, texts["c"]), (7, texts["d"])], key=repr)


def test_mixing(odd_docs, no_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == 12
    total = sum(r["size"] for r in rows)
    taken = sum(r["taken"] for r in rows)
    assert abs(taken - 1.5 * total) <= max(r["size"] for r in rows)  # one holds nearly all words
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    out = mixing.mixed(odd_docs)
    assert out.columns == odd_docs.columns
    assert out.count() == sum(r["copies"] for r in rows)
    assert mixing.mix(no_docs).collect() == [] and mixing.mixed(no_docs).collect() == []


def test_packing(odd_docs, no_docs):
    rows = packing.pack(odd_docs, texts=True).collect()
    texts = {}
    for b in rows:
        for i, start, text in zip(b["doc_ids"], b["starts"], b["texts"]):
            texts.setdefault((i, start), []).append(text)
    long = next(r["text"] for r in odd_docs.collect() if r["doc_id"] == 4)
    assert "".join(texts[4, s][0] for i, s in sorted(k for k in texts if k[0] == 4)) == long
    assert len(texts[8, 0]) == 2 and len(texts[None, 0]) == 2 and texts[2, 0] == [""]
    assert packing.pack(no_docs).collect() == []


@pytest.mark.parametrize("module, label", [(crf, "toxic"), (fm, "quality")])
def test_training_sample_collects_one_text_an_id(spark, monkeypatch, module, label):
    docs = spark.createDataFrame(
        [(k, f"text {k}") for k in range(40)] + [(7, f"the text {j}") for j in range(300)] + [(8, None)],
        "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], f"doc_id long, {label} int")
    known = {
        r["doc_id"]: r[label]
        for r in labels.filter(~module.held_out(labels.doc_id)).collect()
    }
    collected, collect = [], type(docs).toPandas
    monkeypatch.setattr(type(docs), "toPandas", lambda df: collected.append(collect(df)) or collected[-1])
    texts, own, *_ = module.training_sample(docs, labels)
    assert [len(frame) for frame in collected] == [len(known)] and {7, 8} & {*known}
    assert texts == ["" if k == 8 else f"text {k}" for k in sorted(known)]
    assert own == [known[k] for k in sorted(known)]
