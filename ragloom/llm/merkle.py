"""Merkle manifest of a dataset in a van Emde Boas layout.

Leaves are digests of rows. The leaves of a group (a source) stand in order, and
while several nodes remain, runs of FAN neighbours (the last run may be shorter)
become the digest of their joined hex digests; the groups' roots make one more
tree of the same form, whose root is the root of the dataset.

Layout. A tree is split at half its height into a top tree and aligned bottom
trees, and these again, until a piece is at most UNIT levels high: a block, one
row of the manifest. So the blocks of every height come in layers. A block of
height h takes FAN**h neighbouring digests, holds every node above them in the
same recursive order (`address` finds a node by arithmetic alone, without
knowing any cache or page size), and its root is a leaf of a block in the layer
above. Construction goes up, layer by layer, recursing over block roots; paths
to the root go down, so a leaf meets the siblings in its own block and the path
that its block was given once. A group of any size is thousands of bounded blocks;
nothing needs a group in one task, and texts are never moved.

Defined cases: null fields and sources count as such and differ from empty ones;
rows that repeat an id are leaves of their own, in the order of their digests; a
group of one row is its own root; extra columns are not read, whatever their
names; an empty table has no leaf and no root.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragloom.llm.common import keep, release_memory
from ragloom.operators.rows import with_group_ordinal, with_ordinal

FAN = 3
#: Levels of a block above its leaves: FAN ** 6 = 729 digests of 32 bytes.
UNIT = 6
#: Heights that layers are listed for; FAN ** 39 leaves are beyond 64 bits.
HIGHEST = 39
_GROUP = ["known", "name"]


def field(c: Column) -> Column:
    """A value with its length in UTF-8 bytes, or `-`."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(columns: Sequence[Column]) -> Column:
    return F.sha2(F.encode(F.concat(*(field(c) for c in columns)), "utf-8"), 256)


def heights(height: int) -> list[int]:
    """Heights of the layers of a tree, from its leaves up: halves of halves."""
    if height <= UNIT:
        return [height]
    top = height // 2
    return heights(height - top) + heights(top)


def size(height: int, leaves: int) -> int:
    """Nodes of a tree, leaves included."""
    return sum(-(-leaves // FAN ** k) for k in range(height + 1))


def address(height: int, leaves: int, level: int, i: int) -> int:
    """Place of node i of a level (0: leaves) of a tree whose last runs may be
    short: the top half first, then its bottom trees one after another. All
    bottom trees before a given one are full, so their sizes are known."""
    if height == 0:
        return 0
    half = height // 2
    if level > half:
        return address(height - half - 1, -(-leaves // FAN ** (half + 1)), level - half - 1, i)
    tree = i // FAN ** (half - level)
    before = size(height - half - 1, -(-leaves // FAN ** (half + 1))) + tree * size(half, FAN ** half)
    return before + address(half, min(FAN ** half, leaves - tree * FAN ** half), level, i - tree * FAN ** (half - level))


@functools.lru_cache(maxsize=512)
def _addresses(height: int, leaves: int) -> list[list[int]]:
    return [[address(height, leaves, k, i) for i in range(-(-leaves // FAN ** k))] for k in range(height + 1)]


def parent(digests: Sequence[bytes]) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def block(height: int, leaves: Sequence[bytes]) -> bytes:
    """The nodes of a block in the order of their addresses; the root is first."""
    at = _addresses(height, len(leaves))
    out: list[bytes] = [b""] * size(height, len(leaves))
    row = list(leaves)
    for level in range(height + 1):
        for i, d in zip(at[level], row, strict=True):
            out[i] = d
        row = [parent(row[i:i + FAN]) for i in range(0, len(row), FAN)]
    return b"".join(out)


def siblings(nodes: bytes, height: int, leaves: int, i: int) -> list[tuple[bytes, bytes]]:
    """Joined digests left and right of the path from leaf i to the block's root."""
    at = _addresses(height, leaves)
    path = []
    for level in range(height):
        run = i - i % FAN
        path.append((b"".join(nodes[32 * a:32 * a + 32] for a in at[level][run:i]),
                     b"".join(nodes[32 * a:32 * a + 32] for a in at[level][i + 1:run + FAN])))
        i //= FAN
    return path


def fold(digest: bytes, path: Sequence[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and its siblings give."""
    for left, right in path:
        digest = hashlib.sha256((left.hex() + digest.hex() + right.hex()).encode()).digest()
    return digest


def _blocks() -> Column:
    @F.arrow_udf("binary")
    def nodes(height, leaves):
        import pyarrow as pa
        return pa.array([block(h, x) for h, x in zip(height.to_pylist(), leaves.to_pylist(), strict=True)], pa.binary())

    return nodes("height", "leaves")


def _span(height: str) -> str:
    """SQL: leaves of a full block of that height."""
    return f"element_at(array({', '.join(f'{FAN ** h}L' for h in range(UNIT + 1))}), {height} + 1)"


def _layers(groups: DataFrame) -> DataFrame:
    """Groups with `n` leaves: `heights`, the height of each of their layers."""
    upto = F.lit(0)
    for h in range(1, HIGHEST + 1):
        upto = F.when(F.col("n") > FAN ** (h - 1), h).otherwise(upto)
    lists = F.array(*(F.array(*(F.lit(x) for x in heights(h))) for h in range(HIGHEST + 1)))
    return groups.withColumn("heights", F.get(lists, upto))


def _layer(nodes: DataFrame, layer: int, name: str, payload: str | None = None) -> DataFrame:
    """Blocks of one layer over (group, heights, i, digest): (group, heights, height,
    block, leaves, rest, nodes)."""
    rest = F.col(payload) if payload else F.lit(None).cast("string")
    out = nodes.groupBy(*_GROUP, F.expr(f"i div {_span(f'heights[{layer}]')}").alias("block")).agg(
        F.first("heights").alias("heights"), F.sort_array(F.collect_list(F.struct("i", "digest", rest.alias("rest")))).alias("part"))
    out = out.select(*_GROUP, "block", "heights", F.get("heights", layer).alias("height"), F.col("part.digest").alias("leaves"),
                     F.col("part.rest").alias("rest"))
    return keep(out.withColumn("nodes", _blocks()), f"merkle-{name}-{layer}")


def build(nodes: DataFrame, name: str, payload: str | None = None) -> list[DataFrame]:
    """The manifest of trees over (known, name, heights, i, digest): its layers, from
    the leaves up. The number of rounds is that of the layers of the largest tree:
    one to 729 leaves, two to half a million, four to 10**11."""
    layers = [_layer(nodes, 0, name, payload)]
    while True:
        up = layers[-1].where(F.size("heights") > len(layers)).select(
            *_GROUP, "heights", F.col("block").alias("i"), F.substring("nodes", 1, 32).alias("digest"))
        if up.isEmpty():
            return layers
        layers.append(_layer(up, len(layers), name))


def roots(layers: list[DataFrame]) -> DataFrame:
    """(known, name, root) of every tree."""
    tops = [x.where(F.size("heights") == n + 1).select(*_GROUP, F.substring("nodes", 1, 32).alias("root")) for n, x in enumerate(layers)]
    return functools.reduce(DataFrame.unionByName, tops)


_PATH = "array<struct<left:binary,right:binary>>"


def _leaf_paths(blocks: DataFrame) -> DataFrame:
    """(known, name, i, above): of every leaf of the blocks, the path to the root of all."""
    @F.arrow_udf(f"array<{_PATH}>")
    def paths(nodes, height, leaves, above):
        import pyarrow as pa
        out = []
        for x, h, d, up in zip(nodes.to_pylist(), height.to_pylist(), leaves.to_pylist(), above.to_pylist(), strict=True):
            out.append([[{"left": a, "right": b} for a, b in siblings(x, h, len(d), i)] + up for i in range(len(d))])
        return pa.array(out, pa.list_(pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))))

    first = F.expr(f"block * {_span('height')}").alias("first")
    return blocks.select(*_GROUP, first, F.posexplode(paths("nodes", "height", "leaves", "above")).alias("j", "above")).select(
        *_GROUP, (F.col("first") + F.col("j")).alias("i"), "above")


def with_paths(layers: list[DataFrame], above: DataFrame) -> DataFrame:
    """Blocks of the lowest layer with `above`, the path from their root to the root
    of all; `above` (known, name, above) has the path that begins at a tree's root."""
    down = None
    for n in range(len(layers) - 1, -1, -1):
        tops = layers[n].where(F.size("heights") == n + 1).join(above, _GROUP)
        if down is not None:
            inner = layers[n].where(F.size("heights") > n + 1).join(down, [*_GROUP, "block"])
            tops = tops.unionByName(inner)
        if n == 0:
            return tops
        down = keep(_leaf_paths(tops).withColumnRenamed("i", "block"), f"merkle-down-{n}")


def _verify(batches):
    """Blocks of leaves with what they are to be checked against: a row per leaf."""
    import pyarrow as pa
    kinds = {"doc_id": pa.int64(), "leaf": pa.string(), "subroot": pa.string(), "root": pa.string(), "proof_sha256": pa.string(),
             "folded_root": pa.string(), "verified": pa.bool_()}
    for b in batches:
        for at in range(b.num_rows):
            row = {k: b.column(i)[at].as_py() for i, k in enumerate(b.schema.names)}
            up = [(p["left"], p["right"]) for p in row["above"]]
            sub, root, out = row["subroot"].hex(), row["root"].hex(), []
            for i, (digest, rest) in enumerate(zip(row["leaves"], row["rest"], strict=True)):
                path = siblings(row["nodes"], row["height"], len(row["leaves"]), i) + up
                proof = hashlib.sha256("".join(x.hex() for p in path for x in p).encode()).hexdigest()
                folded = fold(rest["seen"], path)
                out.append((rest["doc_id"], digest.hex(), sub, root, proof, folded.hex(), folded == row["root"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds.values(), strict=True)], list(kinds))
    release_memory()


def verify(leaves: DataFrame) -> DataFrame:
    """Proofs of rows (doc_id, source, leaf, seen), leaf being the row's digest in hex
    and seen the digest now found for it: doc_id, leaf, subroot, root, proof_sha256
    (the digest of all siblings, from the leaf up, left to right), folded_root (of
    what was seen and the leaf's siblings), verified."""
    rows = leaves.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").isNotNull().alias("known"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name"),
        F.unhex("leaf").alias("digest"), F.unhex("seen").alias("seen"))
    rows = with_group_ordinal(rows, _GROUP, ["doc_id", "digest"], "i")  # rows equal in both are equal in what is seen
    groups = keep(_layers(rows.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("n"))).select(*_GROUP, "heights"), "merkle-groups")
    nodes = rows.join(groups, _GROUP).select(*_GROUP, "heights", "i", "digest", F.struct("doc_id", "seen").alias("rest"))
    low = build(nodes, "rows", "rest")

    # the tree over the groups' roots: one group of its own
    tops = keep(with_ordinal(roots(low), _GROUP, "i"), "merkle-roots")
    one = [F.lit(True).alias("known"), F.lit("").alias("name")]
    n = _layers(tops.agg(F.count(F.lit(1)).alias("n"))).select("heights")
    high = build(tops.select("i", F.col("root").alias("digest")).join(F.broadcast(n)).select(*one, "heights", "i", "digest"), "groups")
    end = roots(high)
    paths = _leaf_paths(with_paths(high, end.select(*_GROUP, F.array().cast(_PATH).alias("above")))).select("i", "above")
    end = end.select(F.col("root").alias("all"))
    known = keep(tops.join(paths, "i").join(F.broadcast(end)).select(  # one row
        *_GROUP, F.col("root").alias("subroot"), F.col("all").alias("root"), "above"), "merkle-group-paths")

    blocks = with_paths(low, known.select(*_GROUP, "above")).join(known.select(*_GROUP, "subroot", "root"), _GROUP)
    return blocks.select("nodes", "height", "leaves", "rest", "above", "subroot", "root").mapInArrow(
        _verify, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
