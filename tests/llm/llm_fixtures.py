"""Fixtures of these tests; not a conftest, whose name the tests above import."""

import pytest

EXTRA = ("size", "row", "id", "words", "key", "score", "bucket", "doc", "place", "part", "n", "target")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
SCHEMA = COLUMNS + "".join(f", {c} string" for c in EXTRA)


def _rows():
    words = [f"word{k % 977} the" for k in range(30_000)]
    texts = [
        (0, "the quick brown fox jumps over the lazy dog near a river bank", "b"),
        (1, "the quick brown fox jumps over the lazy dog near a river bank", "a"),  # a copy
        (2, None, "a"),
        (3, "", None),
        (4, " ".join(words), "a"),  # very long
        (5, "!!! ... ---", "c"),
        (6, "Ünïcödé 漢字かな \U0001F600 text of some words and more", "c"),
        (7, "one", None),
        (8, "licensed under the GNU General Public License, version 3. Mail a.b@x.org", "b"),
        (8, "licensed under the GNU General Public License, version 3. Mail a.b@x.org", "b"),
        (None, "a row without an id, of 2020-02-29 and 4111 1111 1111 1111", "a"),
        (None, "another row without an id", None),
    ]
    return [
        (i, t, "en", s, None if t is None else len(t), *("x" for _ in EXTRA)) for i, t, s in texts
    ]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids, texts and sources, empty and long texts, ties, repeated rows, extra columns."""
    return spark.createDataFrame(_rows(), SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(folder):
    import pyarrow.parquet as pq

    return pq.read_table(f"{folder}/documents.parquet").to_pandas()
