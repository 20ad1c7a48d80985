"""Token-ID files: one wavelet matrix per shard.

Documents are ordered by id with a range exchange; each task encodes its run
and cuts it into shards. A shard file holds a header (format, sizes, place of
every part), the document table, and one bit plane per bit of the ids, each
plane stably sorted by the bits above it and compressed on its own. With
counts of set bits as rank directory the planes give token access, counting
and occurrence lookup without decoding the shard; reading everything back is
one pass over the planes.

Defined cases: a null text is empty and holds the end id only; null ids sort
first; repeated rows are documents of their own, in text-hash order; a
document longer than a shard makes one larger shard; an empty table gives no
files and no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ragloom.llm.common import keep, open_store, scratch_path

MAGIC = b"WVMX0001"
SHARD_TOKENS = 1 << 22


class BitPlane:
    """A bit vector with rank and select."""

    def __init__(self, packed: np.ndarray, n: int):
        self.packed, self.n = packed, n
        self.before = np.zeros(len(packed) + 1, np.int64)  # set bits before each byte
        np.cumsum(np.bitwise_count(packed), out=self.before[1:])

    def get(self, i: int) -> int:
        return int(self.packed[i >> 3]) >> (7 - (i & 7)) & 1

    def rank1(self, i: int) -> int:
        head = int(self.packed[i >> 3]) >> (8 - (i & 7)) if i & 7 else 0
        return int(self.before[i >> 3]) + head.bit_count()

    def select(self, bit: int, k: int) -> int:
        """Place of the k-th (from 0) bit of this value."""
        before = self.before if bit else np.arange(len(self.before)) * 8 - self.before
        byte = int(np.searchsorted(before, k, "right")) - 1
        bits = np.unpackbits(self.packed[byte:byte + 1])
        return byte * 8 + int(np.flatnonzero(bits == bit)[k - int(before[byte])])


class WaveletMatrix:
    """Ids of one shard as bit planes, highest bit first."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]):
        self.n, self.packed, self.zeros = n, planes, zeros
        self._planes: dict[int, BitPlane] = {}

    @staticmethod
    def build(ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, zeros = [], []
        for b in range(bits - 1, -1, -1):
            on = (ids >> ids.dtype.type(b)) & ids.dtype.type(1) != 0
            planes.append(np.packbits(on))
            low = ids.take(np.flatnonzero(~on))  # places first: quicker than a mask
            zeros.append(len(low))
            ids = np.concatenate([low, ids.take(np.flatnonzero(on))])
        return WaveletMatrix(len(ids), planes, zeros)

    def plane(self, level: int) -> BitPlane:
        if level not in self._planes:
            self._planes[level] = BitPlane(self.packed[level], self.n)
        return self._planes[level]

    def decode(self) -> np.ndarray:
        """All ids, from the last plane up."""
        kind = np.uint16 if len(self.packed) <= 16 else np.uint32
        below = np.zeros(self.n, kind)
        for level in range(len(self.packed) - 1, -1, -1):
            on = np.unpackbits(self.packed[level], count=self.n).view(bool)
            here = np.empty(self.n, kind)
            here[np.flatnonzero(~on)] = below[:self.zeros[level]]
            here[np.flatnonzero(on)] = below[self.zeros[level]:] | kind(1 << (len(self.packed) - 1 - level))
            below = here
        return below

    def access(self, i: int) -> int:
        out = 0
        for level in range(len(self.packed)):
            p = self.plane(level)
            bit, ones = p.get(i), p.rank1(i)
            i = self.zeros[level] + ones if bit else i - ones
            out = out << 1 | bit
        return out

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        for level in range(len(self.packed)):
            p = self.plane(level)
            a, b = p.rank1(lo), p.rank1(hi)
            if token >> (len(self.packed) - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of `token` among places lo to hi - 1."""
        if token >> len(self.packed):
            return 0
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def select(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of `token`."""
        i = self._range(token, 0, self.n)[0] + k
        for level in range(len(self.packed) - 1, -1, -1):
            bit = token >> (len(self.packed) - 1 - level) & 1
            i = self.plane(level).select(bit, i - self.zeros[level] * bit)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]


def shard_bytes(doc_ids: list, lengths: list[int], ids: np.ndarray, bits: int) -> bytes:
    """The file of one shard."""
    import zstandard
    press = zstandard.ZstdCompressor(level=1).compress
    w = WaveletMatrix.build(ids, bits)
    known = np.array([x is not None for x in doc_ids], np.uint8)
    table = [known.tobytes(), np.array([x or 0 for x in doc_ids], "<i8").tobytes(), np.array(lengths, "<i8").tobytes()]
    parts = [press(x) for x in table] + [press(p.tobytes()) for p in w.packed]
    head = json.dumps({"tokens": w.n, "docs": len(doc_ids), "bits": bits, "zeros": w.zeros,
                       "parts": [len(p) for p in parts]}).encode()
    return b"".join([MAGIC, len(head).to_bytes(4, "little"), head, *parts])


def read_shard(data: bytes) -> tuple[list, np.ndarray, WaveletMatrix]:
    """(document ids, their token counts, wavelet matrix) of one shard file."""
    import zstandard
    if data[:8] != MAGIC:
        raise ValueError("not a token shard")
    size = int.from_bytes(data[8:12], "little")
    head = json.loads(data[12:12 + size])
    at, parts = 12 + size, []
    press = zstandard.ZstdDecompressor()
    for n in head["parts"]:
        parts.append(np.frombuffer(press.decompress(data[at:at + n]), np.uint8))
        at += n
    known, doc_ids, lengths = parts[0], parts[1].view("<i8"), parts[2].view("<i8")
    ids = [int(x) if k else None for x, k in zip(doc_ids, known, strict=True)]
    return ids, lengths, WaveletMatrix(head["tokens"], parts[3:], head["zeros"])


def write_tokens(docs: DataFrame, encoder, end_id: int, vocab_size: int, id_col: str = "doc_id",
                 text_col: str = "text", shard_tokens: int = SHARD_TOKENS, path: str | None = None) -> DataFrame:
    """Encode whole texts in ascending id order into shard files under `path`
    (default: the shared folder) and return the manifest: part, seq, file,
    docs, tokens. `encoder()` runs on the worker and returns an object whose
    encode(texts) gives id arrays. Files of lost task attempts are never in the
    manifest: their names are unique and only finished tasks report them."""
    import pyarrow as pa
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    bits = max(1, int(vocab_size - 1).bit_length())
    kind = np.uint16 if bits <= 16 else np.uint32
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))

    def write(batches):
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids, runs, held = [], [], 0
        enc = encoder()

        def flush():
            store, folder = open_store(path)
            store.create_dir(folder, recursive=True)
            name = f"{uuid.uuid4().hex}.wvm"
            with store.open_output_stream(f"{folder}/{name}", compression=None) as f:
                f.write(shard_bytes(doc_ids, [len(r) for r in runs], np.concatenate(runs), bits))
            return pa.RecordBatch.from_pydict(
                {"part": [part], "seq": [seq], "file": [f"{path}/{name}"], "docs": [len(doc_ids)], "tokens": [held]},
                schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()),
                                  ("docs", pa.int64()), ("tokens", pa.int64())]))

        for b in batches:
            for lo in range(0, b.num_rows, 2048):  # many words at once repeat more
                some = b.slice(lo, 2048)
                texts = ["" if t is None else t for t in some.column(1).to_pylist()]
                for i, ids in zip(some.column(0).to_pylist(), enc.encode(texts), strict=True):
                    doc_ids.append(i)
                    runs.append(np.append(ids, end_id).astype(kind))
                    held += len(runs[-1])
                    if held >= shard_tokens:
                        yield flush()
                        doc_ids, runs, held, seq = [], [], 0, seq + 1
        if doc_ids:
            yield flush()

    return keep(rows.mapInArrow(write, "part int, seq int, file string, docs long, tokens long"), "manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """Manifest with `start`: tokens of all documents before each shard. Sums
    over parts (as many as the range exchange has) are one small window."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = manifest.groupBy("part").agg(F.sum("tokens").alias("t")).select(
        "part", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("_w", F.coalesce(F.sum("tokens").over(within), F.lit(0))).join(totals, "part").select(
        *manifest.columns, (F.col("_w") + F.col("before")).alias("start"))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Every document of the shards, from the files: doc_id, start, n_tokens,
    ids (little-endian unsigned 32-bit integers)."""
    import pyarrow as pa
    files = with_starts(manifest).select("file", "start")
    spread = files.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file")

    def read(batches):
        for b in batches:
            for file, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                store, at = open_store(file)
                with store.open_input_file(at) as f:
                    doc_ids, lengths, matrix = read_shard(f.read())
                ids = matrix.decode().astype("<u4")
                ends = np.cumsum(lengths)
                for lo in range(0, len(doc_ids), 2048):
                    hi = min(lo + 2048, len(doc_ids))
                    first = int(ends[lo - 1]) if lo else 0
                    offsets = np.concatenate([[first], ends[lo:hi]])
                    column = pa.BinaryArray.from_buffers(
                        pa.binary(), hi - lo, [None, pa.py_buffer(((offsets - first) * 4).astype(np.int32).tobytes()),
                                               pa.py_buffer(ids[first:offsets[-1]].tobytes())])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc_ids[lo:hi], pa.int64()), pa.array(start + offsets[:-1], pa.int64()),
                         pa.array(lengths[lo:hi], pa.int64()), column], ["doc_id", "start", "n_tokens", "ids"])

    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
