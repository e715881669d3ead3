"""Every registered query gives the rows of its oracle SQL."""

import pytest
from oracle import ORACLES, QUERIES, compare, connect

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, folder, name):
    assert compare(spark, con, folder, name) is None


def test_contract(spark):
    assert set(ORACLES) == set(QUERIES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    df = contract.entry(spark)
    assert df.columns[0] == "l_orderkey" and df.count() > 0


def test_without_the_optional_subpackage(monkeypatch):
    import sys

    for name in ("corpus_pipeline", "mirrorspan.llm"):
        monkeypatch.setitem(sys.modules, name, None)  # as if it weren't there
        assert set(contract.queries()) == set(QUERIES) and contract.oracle_sql() == ORACLES
        monkeypatch.delitem(sys.modules, name)


def test_nothing_imports_the_optional_subpackage():
    from pathlib import Path

    import mirrorspan

    root = Path(mirrorspan.__file__).parent
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "mirrorspan.llm" not in path.read_text(), path
