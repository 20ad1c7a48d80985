"""Repeated passages removed by a relative Lempel-Ziv parse.

The reference of the parse is the corpus in doc_id order: a passage repeats if
WINDOW consecutive words of it start, the same, in a document with a smaller
doc_id. Every word that such a window covers is removed.

Phrases. Each window has one anchor, its least hash of GRAM words (the leftmost
of equal ones). Consecutive windows with one anchor are a phrase. As windows
choose anchors by their own words alone, equal windows lie in phrases with the
same anchor wherever they are, and a phrase is some twenty windows in one row.

Reference blocks. Phrases are dealt by anchor; each block of anchors indexes
every distinct phrase once, under the smallest doc_id that has it. Anchors that
only one document has are left out first: they can match nothing.

Factors. A document extends its factor greedily while its next phrase stands
whole in the index under a smaller doc_id; such phrases become spans at once.
At the boundaries of factors, where no whole phrase matches, a part of one may:
there, and only where an anchor has several phrases, the windows themselves are
indexed, one for each distinct phrase and not for each document, and matched
windows become spans. So the result is exact: every window is judged either as
part of its phrase or by itself.

Hashes: words by 64 bits; phrases and windows by 64 bits beside the 64 of their anchor.

Defined cases: null and empty texts have no words; rows without a doc_id stay
whole and are no reference; rows that share a doc_id are not references of
each other, rows that also share the text are cut alike; texts are read whole; extra
columns are not read, whatever their names; empty tables give no rows.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragloom.llm.common import SPACE_BYTES, Hasher, keep, mix, pieces, release_memory, utf8

WINDOW = 50
#: Words of an anchor. Short ones are shared by chance, long ones leave a phrase fewer windows.
GRAM = 10
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)


@functools.lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Runs:
    """Hashes of runs of consecutive words, from prefix sums."""

    def __init__(self, words: np.ndarray):
        size = 1 << max(12, len(words).bit_length())  # few sizes, so powers are kept
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * _powers(_BASE, size)[:len(words)], out=self.sums[1:])
        self.inverse = _powers(_INVERSE, size)

    def of(self, start: np.ndarray, size) -> np.ndarray:
        return mix((self.sums[start + size] - self.sums[start]) * self.inverse[start] + np.asarray(size).astype(np.uint64))


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of each `width` consecutive values, the leftmost of equal ones."""
    at, span = np.arange(len(values)), 1

    def meet(left, right):
        return np.where(values[right] < values[left], right, left)

    while span * 2 <= width:
        at = meet(at[:-span], at[span:])
        span *= 2
    over = width - span
    return meet(at[:len(at) - over], at[over:]) if over else at


def phrases_of(hashes: np.ndarray, first_word: np.ndarray, window: int, gram: int):
    """Phrases of texts, whose words have these hashes: (text, first window, number of
    windows, anchor, content) arrays; places count from the first word of the first text."""
    empty = np.empty(0, np.int64)
    if len(hashes) < window:
        return empty, empty, empty, empty, empty
    runs = Runs(hashes)
    grams = runs.of(np.arange(len(hashes) - gram + 1), gram)
    anchor = least_places(grams, window - gram + 1)
    sizes = np.diff(first_word)
    last = np.repeat(first_word[1:], sizes)[:len(anchor)]  # where the text of each window ends
    valid = np.flatnonzero(np.arange(len(anchor)) + window <= last)
    if not len(valid):
        return empty, empty, empty, empty, empty
    at = anchor[valid]
    edge = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1)])
    start, count = valid[edge], np.diff(np.r_[edge, len(valid)])
    text = np.searchsorted(first_word, start, "right") - 1
    content = runs.of(start, count - 1 + window)
    content = mix(content ^ (at[edge] - start).astype(np.uint64))
    return text, start, count, grams[at[edge]].view(np.int64), content.view(np.int64)


def _phrases(window: int, gram: int):
    def run(batches):
        import pyarrow as pa
        hasher = Hasher(SPACE_BYTES, lower=False)
        for b in batches:
            texts = utf8(b.column(2))
            for lo, hi in pieces(texts):
                words, _ = hasher.words(texts[lo:hi])
                text, start, count, anchor, content = phrases_of(words.hash, words.first_word, window, gram)
                if len(text):
                    who = pa.array(text + lo)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(who), b.column(1).take(who), pa.array(anchor), pa.array(content),
                         pa.array(start - words.first_word[text]), pa.array(count.astype(np.int32))],
                        ["doc_id", "text_key", "anchor", "content", "start", "count"])
        release_memory()
    return run


def _windows(window: int):
    """Rows (text, phrases) to the hash of each window of the phrases."""
    def run(batches):
        import pyarrow as pa
        hasher = Hasher(SPACE_BYTES, lower=False)
        for b in batches:
            texts = utf8(b.column(0))
            lists = b.column(1)
            for lo, hi in pieces(texts):
                words, _ = hasher.words(texts[lo:hi])
                if not len(words.hash):
                    continue
                part = lists.slice(lo, hi - lo)
                flat, sizes = part.flatten(), np.asarray(part.value_lengths().fill_null(0))
                anchor, content, start, count = (np.asarray(flat.field(i)) for i in range(4))
                begin = start + np.repeat(words.first_word[:-1], sizes)
                who = np.repeat(np.arange(len(count)), count)
                nth = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
                hashes = Runs(words.hash).of(begin[who] + nth, window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[who]), pa.array(content[who]), pa.array(nth.astype(np.int32)), pa.array(hashes.view(np.int64))],
                    ["anchor", "content", "nth", "hash"])
        release_memory()
    return run


def _joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, text_key, start, size): runs of words, by their first word's number,
    covered by windows that a smaller doc_id has; text_key is xxhash64 of the text."""
    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    found = keep(rows.mapInArrow(_phrases(window, gram), _with(rows, "text_key long, anchor long, content long, start long, count int")),
                 "rlz-phrases")
    shared = keep(found.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("anchor"),
                  "rlz-anchors")
    found = keep(found.join(shared, "anchor", "left_semi"), "rlz-shared")

    index = keep(found.groupBy("anchor", "content").agg(
        F.min(F.struct("doc_id", "text_key", "start", "count")).alias("first")).select(
        "anchor", "content", F.col("first.doc_id").alias("first_id"), F.col("first.text_key").alias("text_key"),
        F.col("first.start").alias("start"), F.col("first.count").alias("count")), "rlz-index")
    placed = found.join(index.select("anchor", "content", "first_id"), ["anchor", "content"])
    whole = placed.where("doc_id > first_id").select("doc_id", "text_key", "start", (F.col("count") - 1 + window).alias("size"))

    # boundaries: windows of distinct phrases whose anchor has several of them
    several = keep(index.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "rlz-several")
    open_ = keep(index.join(several, "anchor", "left_semi"), "rlz-open")
    asked = open_.groupBy(F.col("first_id").alias("doc_id"), "text_key").agg(
        F.collect_list(F.struct("anchor", "content", "start", "count")).alias("phrases"))
    texts = rows.join(asked, ["doc_id", "text_key"]).select("text", "phrases")
    cut = texts.mapInArrow(_windows(window), "anchor long, content long, nth int, hash long").distinct()
    cut = keep(cut.join(open_.select("anchor", "content", "first_id"), ["anchor", "content"]), "rlz-windows")
    earliest = keep(cut.groupBy("anchor", "hash").agg(F.min("first_id").alias("lo"), F.max("first_id").alias("hi")).where("lo < hi")
                    .select("anchor", "hash", "lo"), "rlz-earliest")
    parts = cut.join(earliest, ["anchor", "hash"]).where("lo < first_id").select("anchor", "content", "first_id", "nth")
    parts = keep(parts.groupBy("anchor", "content", F.col("first_id").alias("doc_id")).agg(F.collect_set("nth").alias("nths")), "rlz-parts")
    part = found.join(parts, ["anchor", "content", "doc_id"]).select("doc_id", "text_key", "start", F.explode("nths").alias("nth"))
    part = part.select("doc_id", "text_key", (F.col("start") + F.col("nth")).alias("start"), F.lit(window).alias("size"))
    return whole.unionByName(part)


def _with(rows: DataFrame, rest: str) -> str:
    return f"doc_id {dict(rows.dtypes)['doc_id']}, {rest}"


def _cut(with_text: bool):
    def run(batches):
        import pyarrow as pa
        for b in batches:
            out: list[tuple] = []
            texts = utf8(b.column(1))
            for text, spans in zip(texts, b.column(2).to_pylist(), strict=True):
                words = text.split()  # bytes: blanks and \\x09 to \\x0D only
                n, kept, at = len(words), [], 0
                for lo, hi in _joined_spans([(s["start"], s["start"] + s["size"]) for s in spans or ()]):
                    kept += words[at:lo]
                    at = hi
                kept += words[at:]
                left = b" ".join(kept)
                out.append((n, n - len(kept), hashlib.sha256(left).hexdigest(), left if with_text else None))
            n, gone, sha, left = zip(*out, strict=True) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()),
                 pa.array(left, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])
        release_memory()
    return run


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
                 with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept): every row with its words left,
    joined by single blanks (`kept` is null without `with_text`)."""
    spans = keep(repeated_spans(docs, id_col, text_col, window, gram).distinct().groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("start", "size")).alias("spans")), "rlz-spans")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    rows = rows.join(spans, ["doc_id", "text_key"], "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(_cut(with_text), _with(rows, "n_words long, n_removed long, kept_sha256 string, kept string"))
