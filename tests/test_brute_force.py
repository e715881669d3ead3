"""Random small tables against plain Python definitions of the operators."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st

from mirrorspan.functions.dates import in_window
from mirrorspan.model import RunContext
from mirrorspan.operators.joins import join_test
from mirrorspan.operators.quality import sync_drift
from mirrorspan.operators.window import window_keys, window_replace, window_replace_child

CTX = RunContext(dt.date(2024, 5, 10), 3)
DAYS = [None, *(dt.date(2024, 5, 10) - dt.timedelta(days=d) for d in (-2, 0, 3, 4, 90))]
QUICK = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.one_of(st.none(), st.integers(0, 6))
parent_rows = st.lists(st.tuples(st.integers(0, 6), st.sampled_from(DAYS), st.sampled_from(["a", "b", None])), max_size=8)
unique_parents = st.lists(
    st.tuples(st.integers(0, 6), st.sampled_from(DAYS), st.sampled_from(["a", "b", None])),
    max_size=7, unique_by=lambda r: r[0],
)
child_rows = st.lists(st.tuples(keys, st.integers(0, 2)), max_size=12)


def inside(day):
    return day is not None and day >= CTX.cutoff


def parents(spark, rows):
    return spark.createDataFrame(rows, "id long, day date, v string")


def children(spark, rows):
    return spark.createDataFrame(rows, "id long, n long")


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@QUICK
@given(parent_rows, parent_rows)
def test_window_replace(spark, target, source):
    got = rows_of(window_replace(parents(spark, target), parents(spark, source), ["day"], CTX))
    assert got == Counter([r for r in target if not inside(r[1])] + [r for r in source if inside(r[1])])


@QUICK
@given(st.lists(st.tuples(st.sampled_from(DAYS), st.sampled_from(DAYS)), min_size=1, max_size=8))
def test_two_watermarks(spark, rows):
    df = spark.createDataFrame(rows, "a date, b date")
    assert rows_of(df.filter(in_window(["a", "b"], CTX))) == Counter(r for r in rows if inside(r[0]) or inside(r[1]))


@QUICK
@given(unique_parents, unique_parents, child_rows, child_rows)
def test_window_replace_child(spark, refreshed, source, old, new):
    deleted = window_keys(parents(spark, refreshed), ["id"], ["day"], CTX)
    inserted = window_keys(parents(spark, source), ["id"], ["day"], CTX)
    got = rows_of(window_replace_child(children(spark, old), children(spark, new), deleted, inserted))
    gone = {r[0] for r in refreshed if inside(r[1])}
    fresh = {r[0] for r in source if inside(r[1])}
    assert got == Counter([r for r in old if r[0] not in gone] + [r for r in new if r[0] in fresh])


@QUICK
@given(child_rows, child_rows)
def test_join_test(spark, left, right):
    row = join_test(children(spark, left), children(spark, right), ["id"], ["id"]).first()
    pairs = [(a, b) for a in left for b in right if a[0] is not None and a[0] == b[0]]
    matched = len({a[0] for a, _ in pairs})
    assert tuple(row) == (len(pairs), matched, matched, bool(pairs))


@QUICK
@given(unique_parents, parent_rows)
def test_drift(spark, source, target):
    got = {r.id: r.drift for r in sync_drift(parents(spark, source), parents(spark, target), ["id"]).collect()}
    want = {}
    for key in range(7):
        s, t = [r for r in source if r[0] == key], [r for r in target if r[0] == key]
        if s and not t:
            want[key] = "missing"
        elif t and not s:
            want[key] = "ghost"
        elif len(t) > len(s):
            want[key] = "duplicate"
        elif s and t != s:
            want[key] = "changed"
    assert got == want
