"""The splitter's contract as properties."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from ragloom.operators import chunk as C

TEXT = st.lists(st.sampled_from(["a", "bb", " ", ".", "\n", "\n\n", ". ", "word", "ü"]), max_size=150).map("".join)
SIZE = st.integers(min_value=2, max_value=50)


def _overlap(data, size):
    return data.draw(st.integers(min_value=0, max_value=size - 1))


@settings(max_examples=300, deadline=None)
@given(TEXT, SIZE, st.data())
def test_chunks_cover_the_text_in_order(text, size, data):
    overlap = _overlap(data, size)
    spans = C.split_recursive_spans(text, size, overlap)
    end = start = 0
    for chunk, at in spans:
        assert chunk == chunk.strip() and 0 < len(chunk) <= size and text[at:at + len(chunk)] == chunk
        assert at >= start and end - at <= overlap and not text[end:max(at, end)].strip()
        start, end = at, max(end, at + len(chunk))
    assert not text[end:].strip()
    if text.strip() and len(text) <= size and not any(len(p) >= size for p in text.split("\n\n")):
        assert len(spans) == 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=9), min_size=1, max_size=60), st.integers(min_value=12, max_value=40), st.data())
def test_runs_are_as_long_as_they_can_be(lengths, size, data):
    """One level, words parted by blanks: the next word would not fit a chunk, and
    one word more of the tail would be too long or leave no room for that word."""
    overlap = _overlap(data, size)
    words = [chr(97 + i % 26) * n for i, n in enumerate(lengths)]
    pieces = [words[0], *(" " + w for w in words[1:])]
    place = [0]
    for p in pieces:
        place.append(place[-1] + len(p))
    text = "".join(pieces)
    runs = []
    for chunk, at in C.split_recursive_spans(text, size, overlap, [" "]):
        a = max(i for i, x in enumerate(place) if x <= at)
        runs.append((a, place.index(at + len(chunk))))
    assert runs[0][0] == 0 and runs[-1][1] == len(pieces)
    for (a, b), (c, _) in zip(runs, runs[1:]):
        assert place[b + 1] - place[a] > size
        assert place[b] - place[c] <= overlap and place[b + 1] - place[c] <= size or c == b
        assert c == a + 1 or place[b] - place[c - 1] > overlap or place[b + 1] - place[c - 1] > size
