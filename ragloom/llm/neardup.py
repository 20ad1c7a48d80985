"""Near-duplicate documents: an inverted join over MinHash coordinates.

1. Every text becomes its set of distinct five-word shingles (64-bit hashes)
   and a signature of `COORDS` minima. Texts with equal sets form one class;
   only its smallest document goes on.
2. Each (coordinate, value) pair is a token. Tokens of one class only cannot
   collide and are skipped; a class left with fewer tokens than the threshold
   cannot reach the match threshold and is skipped too. The others post under
   their rarest tokens, as many as two signatures with that many equal
   coordinates must share at least one of (prefix filter).
3. Classes that meet in a posting form blocks (components over edges to the
   smallest class of each posting). Inside a block, cut into pieces of bounded
   bytes that meet pairwise in tasks of their own, equal coordinates are
   counted, pairs at or above the match threshold are confirmed on the full
   sets, and only a spanning forest of the confirmed links leaves the task.
4. Components of the confirmed links give each document its group.

A pair at similarity s matches Binomial(COORDS, s) coordinates; the match
threshold is the largest that such a pair misses with a chance of at most MISS.

Defined cases: a text of fewer than five words is its whole word sequence as
one shingle; a null, empty or blank text has the empty set and is linked with
nothing; repeated rows belong to one class; a null doc_id never names a group
that has another id; extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from math import comb

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ragloom.llm.common import SPACE_BYTES, Hasher, keep, mix, pieces, release_memory, utf8, windows
from ragloom.llm.graph import components

COORDS = 64
SHINGLE = 5
#: Largest chance that a pair exactly at the similarity misses the match threshold.
MISS = 1e-6
#: Bytes of shingle sets in one piece of a block; a task holds two pieces.
PIECE_SET_BYTES = 8 << 20
#: Bytes of texts hashed at once: their words take about 25 times as much of a worker.
HASHED_BYTES = 1 << 18


def match_threshold(percent: int) -> int:
    """Equal coordinates that a pair of similarity percent / 100 has all but surely."""
    s, chance = percent / 100, 0.0
    for m in range(COORDS + 1):
        chance += comb(COORDS, m) * s**m * (1 - s) ** (COORDS - m)
        if chance > MISS:
            return max(1, m)
    return COORDS


_rng = np.random.default_rng(64)
_FACTORS = _rng.integers(1, 2**63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(1, 2**63, COORDS, dtype=np.uint64)
_hasher: list[Hasher] = []


def shingle_sets(texts: list[bytes]):
    """The sorted distinct shingle hashes of each text, one after another."""
    if not _hasher:
        _hasher.append(Hasher(SPACE_BYTES, lower=True))
    for lo, hi in pieces(texts, HASHED_BYTES):
        words, _ = _hasher[0].words(texts[lo:hi])
        run = windows(words.hash, SHINGLE)
        for i in range(hi - lo):
            at = words.of(i)
            n = at.stop - at.start
            if n >= SHINGLE:
                yield np.unique(run[at.start:at.stop - SHINGLE + 1])
            elif n:
                yield mix(windows(words.hash[at], n) + np.uint64(n))
            else:
                yield np.empty(0, np.uint64)


def signature(s: np.ndarray) -> np.ndarray:
    """COORDS minima of the set, 32 bits each."""
    best = np.full(COORDS, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(s), 2048):
        part = (s[None, lo:lo + 2048] ^ _SHIFTS[:, None]) * _FACTORS[:, None]
        np.minimum(best, part.min(axis=1), out=best)
    return (mix(best) >> np.uint64(32)).astype(np.uint32)


def set_id(s: np.ndarray) -> int:
    """64 bits that name a shingle set."""
    total = np.bitwise_xor.reduce(mix(s)) ^ np.uint64(len(s) * 0x9E3779B1)
    return int(np.add.reduce(s * total | np.uint64(1), dtype=np.uint64).astype(np.int64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key (hash of the text), n_shingles, cls (name of the shingle
    set), sig (packed), one row per row of `docs`."""
    import pyarrow as pa
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            n, cls, sig = [], [], []
            for s in shingle_sets(utf8(b.column(2))):
                n.append(len(s))
                cls.append(set_id(s) if len(s) else None)
                sig.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(sig, pa.binary())],
                ["doc_id", "text_key", "n_shingles", "cls", "sig"])
        release_memory()

    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, text_key long, n_shingles long, cls long, sig binary")


def postings(classes: DataFrame, matches: int) -> DataFrame:
    """(token, cls): each class under its rarest tokens, after skipping tokens
    and classes that cannot reach `matches` collisions."""
    import pyarrow as pa

    def unpack(batches):
        place = np.arange(COORDS, dtype=np.uint64) << np.uint64(32)
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                part = b.slice(lo, 4096)
                sig = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(-1, COORDS)
                token = mix(place[None, :] | sig.astype(np.uint64)).view(np.int64).ravel()
                cls = np.repeat(part.column(0).to_numpy(), COORDS)
                yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(cls)], ["token", "cls"])

    tokens = classes.select("cls", "sig").mapInArrow(unpack, "token long, cls long")
    common = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    left = (tokens.join(common, "token").groupBy("cls")
            .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t")).where(F.size("t") >= matches))
    return left.select(F.explode(F.slice("t", F.lit(1), F.size("t") - (matches - 1))).alias("x"), "cls").select(
        F.col("x.token").alias("token"), "cls")


def _forest(left: list, right: list | None, percent: int, matches: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among `left`, or between `left` and
    `right`; items are (cls, signature, set). Counts equal coordinates first,
    then confirms on the full sets through one inverted index."""
    other = right if right is not None else left
    sigs = np.stack([s for _, s, _ in other])
    sizes = np.array([len(s) for _, _, s in other])
    flat = np.concatenate([s for _, _, s in other])
    owner = np.repeat(np.arange(len(other)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = parent.get(p, p)
            x = p
        return x

    links = []
    for i, (cls, sig, shingles) in enumerate(left):
        at = np.flatnonzero((sigs == sig).sum(axis=1) >= matches)
        if right is None:
            at = at[at > i]
        at = [j for j in at.tolist() if root(other[j][0]) != root(cls)]
        if not at:
            continue
        lo, hi = np.searchsorted(flat, shingles, "left"), np.searchsorted(flat, shingles, "right")
        hit = np.flatnonzero(hi > lo)
        both = np.bincount(np.concatenate([owner[lo[x]:hi[x]] for x in hit]) if len(hit) else [], minlength=len(other))
        for j in at:
            a, b = root(cls), root(other[j][0])
            if a != b and 100 * both[j] >= percent * (len(shingles) + int(sizes[j]) - int(both[j])):
                parent[max(a, b)] = min(a, b)
                links.append((cls, other[j][0]))
    return links


def confirmed_links(docs: DataFrame, reps: DataFrame, blocks: DataFrame, percent: int) -> DataFrame:
    """(a, b): a spanning forest per pair of pieces of each block, every link
    confirmed on the full shingle sets. `reps`: cls, doc_id, n_shingles;
    `blocks`: cls, block; `docs`: doc_id, text."""
    import pyarrow as pa
    matches = match_threshold(percent)
    members = blocks.join(reps, "cls")
    # running bytes of the sets of a block cut it into pieces; first within salts, so no block is one group
    salted = members.withColumn("salt", F.pmod(F.xxhash64("cls"), F.lit(64)))
    by_salt = salted.groupBy("block", "salt").agg((F.sum("n_shingles") * 8).alias("bytes"))
    before = F.sum("bytes").over(Window.partitionBy("block").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    offsets = by_salt.select("block", "salt", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.sum(F.col("n_shingles") * 8).over(
        Window.partitionBy("block", "salt").orderBy("cls").rowsBetween(Window.unboundedPreceding, -1))
    cut = salted.withColumn("w", within).join(offsets, ["block", "salt"]).select(
        "cls", "block", "doc_id", ((F.coalesce("w", F.lit(0)) + F.col("before")) / PIECE_SET_BYTES).cast("int").alias("piece"))
    cut = keep(cut, "pieces")
    many = cut.groupBy("block").agg(F.max("piece").alias("last"))
    cut = cut.join(many, "block")
    # texts meet their pieces by shuffle at every size: the members of blocks grow with the corpus
    texts = docs.select("doc_id", "text").join(cut.hint("merge"), "doc_id")
    # every pair of pieces of a block is one group: (piece, partner), the smaller first
    texts = texts.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("last")))).select(
        "text", "cls", "block", F.least("piece", "q").alias("p1"), F.greatest("piece", "q").alias("p2"), "piece")

    def sets(batches):
        for b in batches:
            found, sig, keep_rows = [], [], []
            cls = b.column(1).to_pylist()
            for k, s in enumerate(shingle_sets(utf8(b.column(0)))):
                if len(s) and set_id(s) == cls[k]:
                    keep_rows.append(k)
                    found.append(s.tobytes())
                    sig.append(signature(s).tobytes())
            rows = b.take(pa.array(keep_rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[1:], pa.array(sig, pa.binary()), pa.array(found, pa.binary())],
                ["cls", "block", "p1", "p2", "piece", "sig", "shingles"])
        release_memory()

    rows = texts.mapInArrow(sets, "cls long, block long, p1 int, p2 int, piece int, sig binary, shingles binary")

    def link(batches):
        group, held = None, {}
        for b in batches:
            for cls, block, p1, p2, piece, sig, found in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if group != (block, p1, p2):
                    if group:
                        yield from flush(group, held)
                    group, held = (block, p1, p2), {}
                held.setdefault(piece, {})[cls] = (cls, np.frombuffer(sig, np.uint32), np.frombuffer(found, np.uint64))
        if group:
            yield from flush(group, held)
        group, held = None, {}
        release_memory()

    def flush(group, held):
        _, p1, p2 = group
        found = []
        if p1 == p2:
            found = _forest(list(held[p1].values()), None, percent, matches)
        elif p1 in held and p2 in held:
            found = _forest(list(held[p1].values()), list(held[p2].values()), percent, matches)
        if found:
            a, b = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return (rows.repartition("block", "p1", "p2").sortWithinPartitions("block", "p1", "p2", "piece")
            .mapInArrow(link, "a long, b long"))


def near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, text_key, n_shingles, cls, component (the
    name of its group; null without words), component_id (the smallest doc_id reachable
    over links of similarity >= percent / 100) and kept (doc_id = component_id)."""
    prints = keep(fingerprints(docs, id_col, text_col), "prints")
    classes = keep(prints.where("n_shingles > 0").groupBy("cls").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")), "classes")
    posts = keep(postings(classes, match_threshold(percent)), "postings")
    hubs = posts.groupBy("token").agg(F.min("cls").alias("b"))
    stars = posts.join(hubs, "token").where("cls <> b").select(F.col("cls").alias("a"), "b").distinct()
    blocks = components(stars).select(F.col("node").alias("cls"), F.col("component").alias("block"))
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    links = confirmed_links(named, classes.select("cls", "doc_id", "n_shingles"), blocks, percent)
    groups = components(links).withColumnRenamed("node", "cls")
    least = classes.join(groups, "cls").groupBy("component").agg(F.min("doc_id").alias("least"))
    merged = groups.join(least, "component").select("cls", "component", "least")
    named_classes = classes.join(merged, "cls", "left").select(
        "cls", F.coalesce("component", "cls").alias("component"), F.coalesce("least", "doc_id").alias("component_id"))
    out = prints.drop("sig").join(named_classes, "cls", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "text_key", "n_shingles", "cls", "component", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row of each group, that of its smallest doc_id, and all columns
    under any names. Groups are of texts: rows that share a doc_id are one only if their texts are
    near; of rows that repeat doc_id and text one stays. Documents without words
    and rows without a doc_id all stay."""
    found = keep(near_duplicates(docs, percent, id_col, text_col), "neardup").where("cls IS NOT NULL AND doc_id IS NOT NULL")
    best = keep(found.groupBy("component").agg(F.min(F.struct("doc_id", "text_key")).alias("best")), "neardup-best")
    flags = found.join(best, "component").groupBy("doc_id", "text_key").agg(
        F.max(F.struct("doc_id", "text_key") == F.col("best")).alias("stays"), (F.count(F.lit(1)) > 1).alias("repeats"))
    whole = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"))
    marked = whole.join(flags, ["doc_id", "text_key"], "left").where(F.col("stays").isNull() | F.col("stays"))
    marked = keep(marked.select("row", "doc_id", "text_key", F.coalesce("repeats", F.lit(False)).alias("repeats")), "neardup-marked")
    once = marked.where("repeats").groupBy("doc_id", "text_key").agg(F.first("row").alias("row"))
    return marked.where("NOT repeats").select("row").unionByName(once.select("row")).select("row.*")
