"""Chunking operators (explode-type): C1 fixed windows, C2 recursive splitter,
C4 page concatenation, C5 query chunking.

C1 is pure JVM expressions (`sequence` + `posexplode` + `substring`), so it
stays inside whole-stage codegen and is narrow: chunks of a document are
produced in the task that read the document, no shuffle.

C2 (recursive separators with greedy carry) does not reduce to a window
expression; it runs as one Arrow UDF returning
`array<struct<chunk_no, start, text>>` that is then `inline`d, still narrow.
"""

from __future__ import annotations

import bisect
import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The splitter defaults and separator order used by the reference
# (1000 characters per chunk, 200 characters of overlap, separators tried in
# this order: blank line, newline, sentence end, space, single character).
DEFAULT_CHUNK_SIZE = 1000
DEFAULT_CHUNK_OVERLAP = 200
DEFAULT_SEPARATORS = ["\n\n", "\n", ". ", " ", ""]


def _check(size: int, overlap: int) -> None:
    if size <= 0:
        raise ValueError("chunk size must be positive")
    if overlap < 0 or overlap >= size:
        raise ValueError(f"overlap ({overlap}) must be in [0, size={size})")


def chunk_starts(text: Column, size: int, overlap: int) -> Column:
    """0-based start offsets of the fixed windows over `text`.

    Window i covers [i*step, i*step + size) with step = size - overlap; a new
    window starts while characters remain beyond the previous overlap.
    """
    step = size - overlap
    n = F.length(text)
    return F.sequence(F.lit(0), F.greatest(n - F.lit(overlap + 1), F.lit(0)), F.lit(step))


def chunk_fixed(df: DataFrame, text_col: str = "text", size: int = DEFAULT_CHUNK_SIZE,
                overlap: int = DEFAULT_CHUNK_OVERLAP, out_col: str = "chunk") -> DataFrame:
    """Character windows of `size` with `overlap`; one row per chunk.

    Adds `chunk_no` (0-based int), `chunk_start` (0-based int) and `out_col`.
    All other columns are carried (C3 `inherit_metadata`). Empty texts yield
    no chunk.
    """
    _check(size, overlap)
    other = [c for c in df.columns]
    exploded = (
        df.filter(F.length(F.col(text_col)) > 0)
        .select(*other, F.posexplode(chunk_starts(F.col(text_col), size, overlap))
                .alias("chunk_no", "chunk_start"))
    )
    return exploded.withColumn(
        out_col, F.substring(F.col(text_col), F.col("chunk_start") + 1, F.lit(size))
    )


# ---------------------------------------------------------------------------
# Recursive splitter (Arrow UDF)
# ---------------------------------------------------------------------------

def _split_keep(text: str, sep: str, offset: int) -> list[tuple[str, int]]:
    """Split keeping the separator at the start of the following piece; each
    piece carries its start offset in the document."""
    if sep == "":
        return [(ch, offset + i) for i, ch in enumerate(text)]
    out, pos = [], 0
    for i, part in enumerate(text.split(sep)):
        piece = part if i == 0 else sep + part
        if piece:
            out.append((piece, offset + pos))
        pos += len(piece)
    return out


def _merge(pieces: list[tuple[str, int]], size: int, overlap: int) -> list[tuple[str, int]]:
    """Contract step 4 on lengths alone: with the running length before each piece, a
    run ends at the last piece that fits, and the next one begins at the first
    piece from which the carried tail fits `overlap` and leaves room for the
    piece that did not fit. Both are searches in a sorted list."""
    before = [0, *itertools.accumulate(len(p) for p, _ in pieces)]
    out: list[tuple[str, int]] = []
    a, n = 0, len(pieces)
    while a < n:
        b = max(a + 1, bisect.bisect_right(before, before[a] + size) - 1)
        run = "".join(p for p, _ in pieces[a:b])
        if text := run.strip():
            out.append((text, pieces[a][1] + len(run) - len(run.lstrip())))
        if b == n:
            break
        a = bisect.bisect_left(before, max(before[b] - overlap, before[b + 1] - size), a + 1, b)
    return out


def split_recursive_spans(text: str, size: int = DEFAULT_CHUNK_SIZE, overlap: int = DEFAULT_CHUNK_OVERLAP,
                          separators: list[str] | None = None, offset: int = 0) -> list[tuple[str, int]]:
    """C2 splitter returning `(chunk, start offset)` pairs (one document)."""
    _check(size, overlap)
    seps = list(DEFAULT_SEPARATORS if separators is None else separators)
    if not text:
        return []
    sep, rest = seps[-1], []
    for i, s_ in enumerate(seps):
        if s_ == "" or s_ in text:
            sep, rest = s_, seps[i + 1:]
            break
    out: list[tuple[str, int]] = []
    small: list[tuple[str, int]] = []
    for p, start in _split_keep(text, sep, offset):
        if len(p) < size:
            small.append((p, start))
            continue
        if small:
            out.extend(_merge(small, size, overlap))
            small = []
        if rest:
            out.extend(split_recursive_spans(p, size, overlap, rest, start))
        else:
            out.append((p, start))
    if small:
        out.extend(_merge(small, size, overlap))
    return out


def split_recursive(text: str, size: int = DEFAULT_CHUNK_SIZE, overlap: int = DEFAULT_CHUNK_OVERLAP,
                    separators: list[str] | None = None) -> list[str]:
    """Pure-Python splitter used inside the Arrow UDF (one document at a time)."""
    return [c for c, _ in split_recursive_spans(text, size, overlap, separators)]


_CHUNK_ARRAY = T.ArrayType(T.StructType([
    T.StructField("chunk_no", T.IntegerType()),
    T.StructField("chunk_start", T.IntegerType()),
    T.StructField("chunk", T.StringType()),
]))


#: Documents, and bytes of their texts, that are cut at once: what a worker holds beside its batch.
CUT_ROWS, CUT_BYTES = 64, 1 << 20


def _bounded(sizes: list[int]):
    """(from, to) of runs of at most CUT_ROWS sizes and, if of several, CUT_BYTES."""
    at, held = 0, 0
    for i, n in enumerate(sizes):
        if i > at and (i - at >= CUT_ROWS or held + n > CUT_BYTES):
            yield at, i
            at, held = i, 0
        held += n
    if at < len(sizes):
        yield at, len(sizes)


def _recursive_udf(size: int, overlap: int, separators: list[str] | None):
    @F.arrow_udf(_CHUNK_ARRAY)
    def split_col(texts):
        import pyarrow as pa
        import pyarrow.compute as pc
        to = pa.list_(pa.struct([("chunk_no", pa.int32()), ("chunk_start", pa.int32()), ("chunk", pa.string())]))
        done = []
        for a, b in _bounded([n or 0 for n in pc.binary_length(texts).to_pylist()]):
            cut = [[{"chunk_no": i, "chunk_start": pos, "chunk": c}
                    for i, (c, pos) in enumerate(split_recursive_spans(t, size, overlap, separators))] if t is not None else []
                   for t in texts.slice(a, b - a).to_pylist()]
            done.append(pa.array(cut, to))
        return pa.concat_arrays(done) if done else pa.array([], to)

    return split_col


def chunk_recursive(df: DataFrame, text_col: str = "text", size: int = DEFAULT_CHUNK_SIZE,
                    overlap: int = DEFAULT_CHUNK_OVERLAP, separators: list[str] | None = None) -> DataFrame:
    """Recursive separator splitter; one row per chunk (`chunk_no`, `chunk_start`, `chunk`)."""
    _check(size, overlap)
    udf = _recursive_udf(size, overlap, separators)
    return (df.withColumn("__chunks", udf(F.col(text_col)))
              .select(*df.columns, F.inline("__chunks")))


def concat_pages(pages: DataFrame, key: str = "doc_id", order: str = "page", text_col: str = "text",
                 sep: str = "", trailing: str = "") -> DataFrame:
    """C4: join page texts of one document in page order.

    `sep=""` is the text-extraction form (pages joined with nothing);
    `sep="\n", trailing="\n"` is the OCR form (every page followed by a newline).
    Grouped aggregation: pages of one document are gathered by key, which is
    bounded by the document's own size.
    """
    agg = F.expr(f"listagg({text_col}, '{_sql_escape(sep)}') WITHIN GROUP (ORDER BY {order})")
    out = pages.groupBy(key).agg(agg.alias(text_col))
    if trailing:
        out = out.withColumn(text_col, F.concat(F.col(text_col), F.lit(trailing)))
    return out


def _sql_escape(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
