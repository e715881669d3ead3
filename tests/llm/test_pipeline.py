"""The pipeline, stage by stage, against plain computations on whole tables."""

import numpy as np
import pytest

from llm_fixtures import no_docs, odd_docs  # noqa: F401

import corpus_pipeline
from mirrorspan.llm import crf, feistel, minhash, mixing, packing
from mirrorspan.llm.common import materialized
from mirrorspan.llm.queries import PSEUDONYM_KEY


@pytest.fixture(scope="module")
def stages(spark, folder):
    """The documents before each stage, and the result."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialized(stage(spark, out[-1], folder), f"test-{name}"))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stage_names_and_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "pseudonyms", "mixing", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_toxicity(spark, folder, stages):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = crf.train(*crf.training_sample(stages[0], labels))
    before = texts(stages[0])
    scorer = crf.Scorer(model)
    want = {i: t for i, t in before.items() if scorer.score([t])[0][0] < 0.5}
    assert texts(stages[1]) == want and 0 < len(want) < len(before)


def test_near_duplicates(stages):
    before = texts(stages[1])
    ids = sorted(before)
    grams = dict(zip(ids, (minhash.kmers(w) for w in minhash.Hasher().words([before[i] for i in ids]))))
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and minhash.aligned(grams[a], grams[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    want = {i: before[i] for i in ids if root(i) == i}
    assert texts(stages[2]) == want and len(want) < len(ids)


def test_pseudonyms(stages):
    want = {
        i: feistel.pseudonymise(t, PSEUDONYM_KEY)[0] for i, t in texts(stages[2]).items()
    }
    assert texts(stages[3]) == want
    assert all(r["n_chars"] == len(r["text"]) for r in stages[3].collect())


def test_mixing(stages):
    before, after = stages[3].collect(), stages[4].collect()
    size = {r["doc_id"]: len(r["text"].split()) for r in before}
    source = {r["doc_id"]: r["source"] for r in before}
    words, names = {}, sorted(set(source.values()))
    for i, s in source.items():
        words[s] = words.get(s, 0) + size[i]
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
    left, free, target = 1.5 * sum(words.values()), set(names), {}
    while True:  # clamp and share again
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > 2 * words[s]}
        if not above:
            break
        for s in above:
            target[s] = 2 * words[s]
            left -= target[s]
        free -= above
    target |= {s: level * weight[s] for s in free}
    copies, taken = {}, dict.fromkeys(names, 0)
    for r in after:
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
        taken[r["source"]] += size[r["doc_id"]]
    assert max(copies.values()) <= 2
    for s in names:  # whole documents only
        assert abs(taken[s] - target[s]) <= max(size[i] for i in source if source[i] == s)


def test_packing(stages):
    want = sorted((r["doc_id"], r["text"]) for r in stages[4].collect())
    pieces = {}
    for b in stages[5].collect():
        assert b["capacity"] in packing.CAPACITIES and sum(b["sizes"]) == b["used"] <= b["capacity"]
        for i, start, text in zip(b["doc_ids"], b["starts"], b["texts"]):
            pieces.setdefault((i, start), []).append(text)
    got = []
    for i in {i for i, _ in pieces}:
        parts = [pieces[k] for k in sorted(k for k in pieces if k[0] == i)]
        got += [(i, "".join(own)) for own in zip(*parts)]
    assert sorted(got) == want


def test_run_gives_the_last_stage(spark, folder, stages):
    def digest(df):
        return sorted((tuple(r["doc_ids"]), tuple(r["sizes"]), r["capacity"]) for r in df.collect())

    assert digest(corpus_pipeline.run(spark, folder)) == digest(stages[5])
    assert np.sum([r["used"] for r in stages[5].collect()]) > 0


@pytest.fixture(scope="module")
def odd_folder(odd_docs, spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    odd_docs.write.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame([(0, 1, 0), (4, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_on_odd_rows(spark, odd_docs, odd_folder):
    """Nulls, shared ids, repeated rows, a long text, columns of clashing names."""
    docs = spark.read.parquet(f"{odd_folder}/documents.parquet")
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialized(stage(spark, docs, odd_folder), f"odd-{name}")
        if name != "packing":
            assert docs.columns == odd_docs.columns
            assert {(r["doc_id"], r["source"], r["lang"]) for r in docs.collect()} <= {
                (r["doc_id"], r["source"], r["lang"]) for r in before.collect()}
        counts.append(docs.count())
    # Only what is labelled toxic may go; 0 and 1, the two rows of 8 and the empty ones are copies.
    assert counts[0] >= 11 and counts[1] == counts[2] == counts[0] - 4
    assert counts[3] > 0 and counts[4] > 0


def test_run_on_an_empty_table(spark, no_docs, tmp_path):
    no_docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
