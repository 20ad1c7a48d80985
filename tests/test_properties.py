"""Property tests (hypothesis): splitter invariants, fixed-window arithmetic,
and repartition invariance of registered queries."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from ragloom.operators import chunk as C
from tests.conftest import SF001

TEXT = st.lists(st.sampled_from(["a", "b", "é", " ", ".", "\n", "\n\n", ". ", "word", "longerword"]),
                max_size=120).map("".join)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(min_value=2, max_value=60), st.data())
def test_recursive_splitter_invariants(text, size, data):
    overlap = data.draw(st.integers(min_value=0, max_value=size - 1))
    spans = C.split_recursive_spans(text, size, overlap)
    prev = -1
    covered = set()
    for c, start in spans:
        assert 0 < len(c) <= size
        assert c == c.strip()
        assert text[start:start + len(c)] == c          # exact position in the document
        assert start >= prev                             # starts never go back
        prev = start
        covered.update(range(start, start + len(c)))
    if text.strip() and len(text) <= size:
        assert [c for c, _ in spans] == [text.strip()]
    assert all(i in covered for i, ch in enumerate(text) if not ch.isspace())


@settings(max_examples=300, deadline=None)
@given(st.integers(min_value=0, max_value=5000), st.integers(min_value=1, max_value=300), st.data())
def test_fixed_window_arithmetic(n, size, data):
    """The window starts used by C1 tile the text: every character is in a
    window, consecutive windows overlap by exactly `overlap`, no window is
    redundant."""
    overlap = data.draw(st.integers(min_value=0, max_value=size - 1))
    step = size - overlap
    starts = list(range(0, max(n - overlap - 1, 0) + 1, step)) if n > 0 else []
    if n == 0:
        return
    assert starts[0] == 0
    assert starts[-1] + size >= n                     # the end is covered
    if len(starts) > 1:
        assert starts[-2] + size < n                  # the last window is needed
    for a, b in zip(starts, starts[1:]):
        assert b - a == step


# Every registered query except those whose answer legitimately depends on the
# data layout (KMeans initialisation samples per partition) and the streams
# (checked against their batch twins in test_streaming.py).
INVARIANT_QUERIES = sorted(n for n in E.queries() if not n.startswith(("ann_", "stream_")))


@pytest.mark.parametrize("name", INVARIANT_QUERIES)
def test_results_independent_of_partitioning(spark, name):
    q = E.queries()[name]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = q(spark, SF001).collect()
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        b = q(spark, SF001).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(tuple, a), key=repr) == sorted(map(tuple, b), key=repr)
