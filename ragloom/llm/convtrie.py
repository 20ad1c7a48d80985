"""Prefix trie of conversations by fixed-length block hashing.

A conversation is a sequence of turns; every distinct sequence of its first d
turns is a node of the trie. Sixteen bytes of SHA-256 stand for a turn, and no
text moves after that. BLOCK consecutive turns make a block, BLOCK blocks a
block of the next level, and so on, so the prefix before any block is found
top-down, level by level: the prefix before its parent block plus the digests
of the siblings before it. No task walks a conversation from its start, and the
number of rounds is the logarithm of the longest one.

Conversations are then grouped by (prefix, whole block). Where all that share a
prefix go on with one block, its turn boundaries are nodes as they stand; only
where several blocks follow one prefix (siblings diverge) are the blocks cut
into turns and grouped again, and that over distinct blocks, not conversations.

Sums over a subtree need no walk either: the smallest member of a node is its
owner, and each node counts towards the conversation that owns it. A subtree's
sum is the sum over its members of what they own, less what its own owner has
above it (`trie`).

Defined cases: rows without a conv_id belong to no conversation; null turns come
first, rows of one turn number follow in the order of their digests, repeated
rows are turns of their own; null roles and texts are empty; extra columns are
not read, whatever their names; an empty table has no node, not even a root.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragloom.llm.common import keep
from ragloom.operators.rows import with_group_ordinal

#: Turns of a block, and blocks of a block of the next level.
BLOCK = 8
WORD = r"[^\x20\x09-\x0D]+"
#: Ids joined into one row while a list of ids is hashed.
CHUNK_IDS = 4096


def root() -> Column:
    """Key of the prefix without turns."""
    return F.lit(bytes(16))


def digest(level: int, *parts: Column) -> Column:
    """16 bytes of SHA-256 over binary parts, apart for each level."""
    return F.substring(F.unhex(F.sha2(F.concat(F.lit(bytes([level])), *parts), 256)), 1, 16)


def number_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, k, digest, words): turns in order, k from 0. One long
    conversation is numbered by many tasks."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    size = F.concat(F.octet_length(role).cast("string"), F.lit(":"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        digest(0, F.encode(F.concat(size, role, text), "utf-8")).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    return with_group_ordinal(turns, ["conv_id"], ["turn", "digest", "words"], "k").select("conv_id", "k", "digest", "words")


def graft(turns: DataFrame, base: Column, taken: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns come from another: the first `taken` (at
    most `most`) turns of conversation `base`, then the own turns after the first
    `taken`. `base` and `taken` are columns over conv_id. Returns every
    conv_id, also those without a turn left, and the turns."""
    heads = turns.where(F.col("k") < most).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("k", "digest", "words"))).alias("head"))
    ids = turns.select("conv_id").distinct().select("conv_id", base.cast("long").alias("base"), taken.cast("int").alias("taken"))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("taken")), F.array().cast("array<struct<k:bigint,digest:binary,words:bigint>>"))
    ids = keep(ids.join(heads, "base", "left").select("conv_id", "taken", head.alias("head")), "trie-heads")
    first = ids.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.k", "t.digest", "t.words")
    shift = ids.select("conv_id", "taken", F.size("head").alias("had"))
    rest = turns.join(shift, "conv_id").where(F.col("k") >= F.col("taken")).select(
        "conv_id", (F.col("k") - F.col("taken") + F.col("had")).alias("k"), "digest", "words")
    return ids.select("conv_id"), first.unionByName(rest)


def _grouped(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, k, digest, words) in groups of BLOCK consecutive k."""
    return rows.groupBy("conv_id", F.floor(F.col("k") / BLOCK).cast("long").alias("b")).agg(
        F.sort_array(F.collect_list(F.struct("k", "digest", "words"))).alias("parts"))


def _joined(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["digest"]))


def _total(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + x["words"])


def _steps(level: int) -> Column:
    """Of a group of level `level` with the prefix `key` and `before` words before
    it: the same of each part, and `next`, the key of the prefix with the part. The
    prefix with a full group has the key that the level above gave it."""
    def upto(n):
        return digest(2 * level + 2, F.col("key"), _joined(F.slice("parts", F.lit(1), n)))

    def at(part, i):
        return F.struct(
            F.when(i == 0, F.col("key")).otherwise(upto(i)).alias("key"),
            F.when(i + 1 == BLOCK, F.col("next")).otherwise(upto(i + 1)).alias("next"),
            (F.col("before") + _total(F.slice("parts", F.lit(1), i))).alias("before"), part.alias("part"))

    return F.transform("parts", at)


def blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, b, key, next, before, parts): every block of BLOCK turns, with the
    key of the prefix before it, that of the prefix with it, and the words before it."""
    levels = [keep(_grouped(turns), "trie-blocks")]
    most = levels[0].agg(F.max("b")).first()[0]
    while most:  # one round more for each BLOCK-fold length of the longest conversation
        above = levels[-1].select("conv_id", F.col("b").alias("k"), digest(2 * len(levels) - 1, _joined(F.col("parts"))).alias("digest"),
                                  _total(F.col("parts")).alias("words"))
        levels.append(keep(_grouped(above), "trie-blocks"))
        most //= BLOCK
    whole = digest(2 * len(levels), root(), _joined(F.col("parts")))
    known = levels[-1].select("conv_id", "b", root().alias("key"), whole.alias("next"), F.lit(0).cast("long").alias("before"), "parts")
    for n in range(len(levels) - 1, 0, -1):
        steps = known.select("conv_id", F.explode(_steps(n)).alias("s")).select(
            "conv_id", F.col("s.part.k").alias("b"), "s.key", "s.next", "s.before")
        known = levels[n - 1].join(steps, ["conv_id", "b"]).select("conv_id", "b", "key", "next", "before", "parts")
    end = F.when(F.size("parts") == BLOCK, F.col("next")).otherwise(digest(2, F.col("key"), _joined(F.col("parts"))))
    return known.withColumn("next", end)


def _runs(batches):
    """Sorted (node, conv_id) rows of one task: the digest of every list of ids that
    lies inside the task and is short; pieces of all other lists."""
    import pyarrow as pa

    def batch():
        cols = zip(*out, strict=True)
        kinds = {"node": pa.binary(), "first": pa.int64(), "ids": pa.string(), "sha": pa.string()}
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds.values(), strict=True)], list(kinds))

    out: list[tuple] = []
    node, ids, parted = None, [], True  # parted: another task or row may hold more of the list
    for b in batches:
        for this, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if this != node:
                if ids:
                    text = ",".join(ids)
                    out.append((node, int(ids[0]), text, None) if parted else
                               (node, None, None, hashlib.sha256(text.encode()).hexdigest()))
                node, ids, parted = this, [], node is None
            ids.append(str(conv))
            if len(ids) == CHUNK_IDS:
                out.append((node, int(ids[0]), ",".join(ids), None))
                ids, parted = [], True
        if out:
            yield batch()
            out = []
    if ids:
        out.append((node, int(ids[0]), ",".join(ids), None))
        yield batch()


def _lists(batches):
    """Pieces of lists in order: the digest of each list, one piece held at a time."""
    import pyarrow as pa
    node, sha = None, None
    for b in batches:
        done = []
        for this, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if this != node:
                if sha is not None:
                    done.append((node, sha.hexdigest()))
                node, sha = this, hashlib.sha256(text.encode())
            else:
                sha.update(b"," + text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([v for _, v in done])], ["node", "sha"])
    if sha is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([sha.hexdigest()])], ["node", "sha"])


def id_digests(ends: DataFrame) -> DataFrame:
    """(node, sha): SHA-256 of the ascending decimal conv_ids of each node of
    `ends` (node, conv_id), joined by commas. Ids are sorted by range, so a long list
    is joined by many tasks; its last pass, which SHA-256 needs in order, streams
    one row per CHUNK_IDS ids."""
    runs = keep(ends.select("node", "conv_id").orderBy("node", "conv_id").mapInArrow(
        _runs, "node binary, first long, ids string, sha string"), "trie-ends")
    parted = runs.where("sha IS NULL").select("node", "first", "ids").repartition("node").sortWithinPartitions("node", "first")
    return runs.where("sha IS NOT NULL").select("node", "sha").unionByName(
        parted.select("node", "ids").mapInArrow(_lists, "node binary, sha string"))


def trie(ids: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the trie over the conversations `ids` (conv_id) with `turns`
    (conv_id, k from 0, digest, words): node, parent, depth, conv_id (the smallest
    member), parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    saved_tokens of a node: over its subtree, (members - 1) * words of the last turn.
    The first product summed is, over the node's members, their words from that
    turn on; the words counted once belong to owners, so they are what the members
    own, less what the node's own owner has above the node."""
    cut = keep(blocks(turns), "trie-cut")
    convs = ids.join(cut.groupBy("conv_id").agg(F.max(F.struct("b", "next")).alias("last"), F.sum(_total(F.col("parts"))).alias("all")),
                     "conv_id", "left")
    convs = keep(convs.select("conv_id", F.coalesce("last.next", root()).alias("end"),
                              F.coalesce("all", F.lit(0)).cast("long").alias("all")), "trie-conversations")

    # first by whole blocks, then by turns where several blocks follow one prefix
    distinct = keep(cut.groupBy("next").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("owner"),
        *(F.first(c).alias(c) for c in ("b", "key", "before", "parts"))), "trie-distinct")
    forks = keep(distinct.groupBy("key").agg(F.count(F.lit(1)).alias("ways")).where("ways > 1"), "trie-forks")
    steps = distinct.join(forks, "key", "left").select(
        F.col("next").alias("block"), "n", "owner", F.col("ways").isNotNull().alias("forked"), "b", F.explode(_steps(0)).alias("s"))
    steps = keep(steps.select("block", "n", "owner", "forked", F.col("s.next").alias("node"), F.col("s.key").alias("parent"),
                              (F.col("s.part.k") + 1).alias("depth"), F.col("s.part.words").alias("words"), "s.before"), "trie-steps")
    same = ["parent", "depth", "words", "before"]
    top = ids.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("owner")).where("n > 0").select(
        root().alias("node"), "n", "owner", F.lit(None).cast("binary").alias("parent"),
        *(F.lit(0).cast("long").alias(c) for c in same[1:]))
    nodes = (steps.where("forked").groupBy("node").agg(F.sum("n").alias("n"), F.min("owner").alias("owner"), *(F.first(c).alias(c) for c in same))
             .unionByName(steps.where("NOT forked").select("node", "n", "owner", *same)).unionByName(top))
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = keep(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "trie-nodes")

    owned = nodes.groupBy(F.col("owner").alias("conv_id")).agg(
        F.sum("words").alias("own"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    zero = F.lit(0).cast("long")
    convs = keep(convs.join(owned, "conv_id", "left").select(
        "conv_id", "end", "all", F.coalesce("own", zero).alias("own"), F.coalesce("leaf", zero).alias("leaf")), "trie-owned")
    summed = [F.sum(c).alias("sum_" + c) for c in ("all", "own", "leaf")]
    by_block = cut.select("conv_id", F.col("next").alias("block")).join(convs, "conv_id").groupBy("block").agg(*summed)
    again = [F.sum(c).alias(c) for c in ("sum_all", "sum_own", "sum_leaf")]
    sums = steps.select("block", "node").join(by_block, "block").groupBy("node").agg(*again).unionByName(
        convs.agg(*summed).select(root().alias("node"), "sum_all", "sum_own", "sum_leaf"))

    owner = convs.select(F.col("conv_id").alias("owner"), F.col("all").alias("owner_all"), F.col("own").alias("owner_own"))
    above = nodes.select(F.col("node").alias("parent"), F.col("owner").alias("parent_conv_id"))
    ends = id_digests(convs.select(F.col("end").alias("node"), "conv_id"))
    saved = (F.col("sum_all") - F.col("n") * F.col("before") - F.col("sum_own") + F.col("owner_own") - F.col("owner_all") + F.col("before"))
    out = nodes.join(sums, "node").join(owner, "owner").join(above, "parent", "left").join(ends, "node", "left")
    return out.select("node", "parent", F.col("owner").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"),
                      "n_children", F.col("sum_leaf").alias("n_leaves"), saved.cast("long").alias("saved_tokens"),
                      F.coalesce("sha", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))
