"""Helpers of this subpackage: scratch tables, files in the shared folder,
and vectorised word hashing over batches of UTF-8 texts."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ragloom.session import ensure_checkpoint_dir

#: Separator bytes of words `[^\x20\x09-\x0D]+`.
SPACE_BYTES = bytes([0x20, *range(0x09, 0x0E)])
#: Bytes outside words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (text already lower-cased).
NON_ALNUM_BYTES = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

#: Bytes of text hashed at once; words never straddle two pieces.
PIECE_BYTES = 1 << 20

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder named by spark.checkpoint.dir."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Tables that `keep` has written inside `owned`.
_owned: list[str] = []
_owning = [False]


#: Spark's setting that deletes a query's shuffle files when the query ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as a table in the shared folder and return a scan of it
    (cuts lineage; survives lost executors). Shuffle files of the writing go with it."""
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    if _owning[0]:
        _owned.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def owned():
    """Tables kept inside belong to a job that drops them by `drop_owned`."""
    before, _owning[0] = _owning[0], True
    try:
        yield
    finally:
        _owning[0] = before


def drop_owned(spark: SparkSession, needed: DataFrame) -> None:
    """Delete the owned tables, except those that `needed` reads."""
    files = needed.inputFiles()
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    left = []
    for path in _owned:
        if any(path.rsplit("/", 1)[1] in f for f in files):
            left.append(path)
        else:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
    _owned[:] = left


#: Bytes of one Arrow batch between the JVM and a Python worker. Both sides hold
#: whole batches (the JVM outside its heap, in buffers that grow by doubling),
#: and texts are long: Spark's own 64 MB are several hundred MB of an executor.
ARROW_BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch bound to ARROW_BATCH_BYTES. A batch ends
    at the row that passes the bound, so texts stay whole and no row is lost."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


@functools.lru_cache(maxsize=1)
def _trim():
    """glibc's malloc_trim; elsewhere a function that does nothing."""
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return lambda pad: 0


def release_memory() -> None:
    """Give memory that Arrow and the allocator hold but no longer use back to
    the system. Workers live on through the stages of an application: without
    this each keeps what its largest batch took, beside the JVM's own peak."""
    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    _trim()(0)


def open_store(uri: str):
    """(filesystem, path) of a folder in the shared store, on any executor."""
    from pyarrow import fs
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (uint64 in, uint64 out)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


@functools.lru_cache(maxsize=2)
def _piece_powers(base: int) -> np.ndarray:
    return _powers(base, PIECE_BYTES)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """Words of a batch: `doc` (ascending index of the text), `start`, `end`
    (byte places in `data`) and `hash` (64 bits of the word's bytes)."""

    def __init__(self, data: np.ndarray, first: np.ndarray, start, end, hashes):
        self.data, self.start, self.end, self.hash = data, start, end, hashes
        #: words of text i are first_word[i] .. first_word[i + 1]
        self.first_word = np.searchsorted(start, first)
        self.first_byte = first

    def of(self, i: int) -> slice:
        return slice(self.first_word[i], self.first_word[i + 1])


class Hasher:
    """Finds the words of whole texts and hashes them (and fixed-length
    beginnings of them) with prefix sums: no Python object per word."""

    def __init__(self, separators: bytes, lower: bool):
        self.sep = np.zeros(256, bool)
        self.sep[list(separators)] = True
        self.lower = np.arange(256, dtype=np.uint8)
        if lower:
            self.lower[65:91] += 32
        self.pow, self.inv = _piece_powers(_BASE), _piece_powers(_INVERSE)  # shared by all hashers of a worker

    def words(self, texts: Sequence[bytes], prefixes: Sequence[int] = ()) -> tuple[Words, dict[int, np.ndarray]]:
        """All words of the texts; for each length in `prefixes` also the hash
        of the word's first so many bytes (0 for words not longer than that)."""
        gap = bytes([int(np.flatnonzero(self.sep)[-1])]) if not self.sep[32] else b" "
        data = self.lower[np.frombuffer(gap.join(texts) + gap, np.uint8)]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        first = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(lengths + 1, out=first[1:])
        inside = ~self.sep[data]
        edge = np.diff(inside.view(np.int8), prepend=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        hashes = np.empty(len(start), np.uint64)
        heads = {p: np.zeros(len(start), np.uint64) for p in prefixes}
        lo = 0
        while lo < len(start):
            hi = max(lo + 1, int(np.searchsorted(end, start[lo] + PIECE_BYTES - 1, "right")))
            self._hash(data, start[lo:hi], end[lo:hi], hashes[lo:hi], {p: h[lo:hi] for p, h in heads.items()})
            lo = hi
        return Words(data, first, start, end, hashes), heads

    def _hash(self, data, start, end, out, heads) -> None:
        a, n = int(start[0]), int(end[-1] - start[0])
        if n < PIECE_BYTES:
            power, inverse = self.pow[:n], self.inv
        else:  # one word longer than a piece
            power, inverse = _powers(_BASE, n), self.inv
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data[a:a + n]] * power, out=total[1:])
        s, e = start - a, end - a
        out[:] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64))
        for p, head in heads.items():
            longer = np.flatnonzero(e - s > p)
            t = s[longer]
            head[longer] = mix((total[t + p] - total[t]) * inverse[t] + np.uint64(p + (1 << 40)))


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` consecutive word hashes."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, width):
        out = mix(out * np.uint64(_BASE) + h[j:j + n])
    return out


def pieces(texts: Sequence[bytes], most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs of texts of about `most` bytes (one text at least)."""
    lo = size = 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > most:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def utf8(column) -> list[bytes]:
    """An Arrow string column as bytes, null as empty."""
    import pyarrow as pa
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]
