"""Conversation trie, Merkle manifest and substring dedup against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ragloom.llm import convtrie, merkle, queries, rlz


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def query(spark, tmp_path, name, **tables):
    for table, df in tables.items():
        df.write.parquet(f"{tmp_path}/{table}.parquet")
    return queries.QUERIES[name](spark, str(tmp_path)).collect()


# --- conversation trie ------------------------------------------------------

def trie(rows):
    """Nodes by definition: {prefix: (conv_id, depth, parent, n, children, leaves, saved, ends)}."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append(((t is not None, t or 0), r or "", x or ""))
    turns = {}
    for c, ts in own.items():
        ts.sort(key=lambda t: t[0])
        turns[c] = [t[1:] for t in ts]
    built = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = turns.get(c - int(c % 20), [])[:h] + ts[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[x] for x in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[x] for x in children[p])
    return sorted((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), leaves[p], saved[p],
                   sha(",".join(map(str, sorted(ends[p]))))) for p in members)


TRIE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def check_trie(spark, tmp_path, rows, extra=()):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in extra:
        df = df.withColumn(name, F.lit("?"))
    got = query(spark, tmp_path, "op11_conversation_trie", conversations=df)
    assert sorted(tuple(r[c] for c in TRIE_COLUMNS) for r in got) == trie(rows)


def test_trie_random(spark, tmp_path):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "a b", "c  d\te", ""]))
            for c in range(0, 70) for t in range(rng.randint(0, 5))]
    check_trie(spark, tmp_path, rows)


def test_trie_awkward_rows(spark, tmp_path):
    rows = [(0, None, None, None), (0, 1, "user", "x y"), (20, 5, "user", None), (21, 0, "", ""), (22, 0, None, "z"),
            (41, 1, "user", "only"), (None, 0, "user", "lost"), (7, 0, "u", "w " * 30_000), (8, 0, "u", "w " * 30_000),
            (9, 3, "u", "same"), (9, 3, "u", "same"), (2**40 + 3, 0, "é", "ü ß")]
    check_trie(spark, tmp_path, rows, extra=("k", "digest", "words", "node", "b", "key", "next", "head"))


def test_trie_long_and_common_conversations(spark, tmp_path):
    common = [("user", f"t{i} w") for i in range(150)]
    rows = [(c, t, r, x) for c in range(100, 130) for t, (r, x) in enumerate(common[:40 + c % 3 * 30])]
    rows += [(500, t, r, x if t != 120 else "fork") for t, (r, x) in enumerate(common)]
    rows += [(501, t, r, x) for t, (r, x) in enumerate(common)] + [(502, t, r, x) for t, (r, x) in enumerate(common * 4)]
    rows += [(c, t, "user", f"m{t}") for c in range(700, 760) for t in range(2)]
    check_trie(spark, tmp_path, rows)


def test_trie_empty(spark, tmp_path):
    check_trie(spark, tmp_path, [])


def test_long_lists_of_ids(spark, monkeypatch):
    monkeypatch.setattr(convtrie, "CHUNK_IDS", 7)
    rows = [(bytes([n]) * 16, c) for n, size in enumerate((1, 7, 8, 50, 14)) for c in range(10 * n, 10 * n + size)]
    got = {bytes(r["node"]): r["sha"] for r in convtrie.id_digests(spark.createDataFrame(rows, "node binary, conv_id long").repartition(5)).collect()}
    want = defaultdict(list)
    for n, c in rows:
        want[n].append(c)
    assert got == {n: sha(",".join(map(str, sorted(cs)))) for n, cs in want.items()}


# --- Merkle manifest --------------------------------------------------------

def test_addresses_are_a_permutation():
    for height in range(0, 6):
        for leaves in {n for n in (1, 2, 3, 4, 3 ** height, 3 ** height - 1, 3 ** height // 2) if 1 <= n <= 3 ** height}:  # also a last block
            flat = [a for level in merkle._addresses(height, leaves) for a in level]
            assert sorted(flat) == list(range(merkle.size(height, leaves)))
            assert merkle.address(height, leaves, height, 0) == 0                # the root comes first
    assert merkle.heights(5) == [5] and merkle.heights(13) == [4, 3, 6] and all(sum(merkle.heights(h)) == h for h in range(40))


def test_layout_is_recursive():
    """Height 3: the top half's nodes, then each bottom tree whole."""
    at = merkle._addresses(3, 27)
    assert at[3] == [0] and at[2] == [1, 2, 3]
    for k in range(9):
        assert at[1][k] == 4 + 4 * k and at[0][3 * k:3 * k + 3] == [5 + 4 * k, 6 + 4 * k, 7 + 4 * k]


def manifest(rows):
    def part(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r):
        return sha("".join(part(r[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
        return out

    def path(tree, i):
        steps = []
        for row in tree[:-1]:
            run = i - i % 3
            steps.append((row[run:i], row[i + 1:run + 3]))
            i //= 3
        return steps
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[s] = levels([leaf(r) for r in groups[s]])
    top = levels([trees[s][-1][0] for s in names]) if names else []
    out = []
    for n, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            steps = path(trees[s], i) + path(top, n)
            seen = dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None:
                seen["text"] = r["text"].replace("\n", "")
            folded = leaf(seen)
            for a, b in steps:
                folded = sha("".join(a) + folded + "".join(b))
            out.append((r["doc_id"], leaf(r), trees[s][-1][0], top[-1][0], sha("".join(x for a, b in steps for x in a + b)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


MERKLE_COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("unit", [1, 2, 6])
def test_merkle(spark, tmp_path, monkeypatch, unit):
    monkeypatch.setattr(merkle, "UNIT", unit)
    rng = random.Random(unit)
    rows = [dict(doc_id=i, source=rng.choice([None, "", "a", "b", "ü", "big", "big", "big"]), lang=rng.choice([None, "en"]), n_chars=i * 7,
                 text=rng.choice([None, "", "x\ny\n", "no break", "é\n"])) for i in range(300)]
    rows += [dict(doc_id=5, source="a", lang="x", n_chars=None, text="again"), dict(doc_id=5, source="a", lang="x", n_chars=None, text="again"),
             dict(doc_id=None, source=None, lang=None, n_chars=None, text=None), dict(doc_id=1000, source="one", lang="en", n_chars=1, text="\n" * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df = df.withColumns({c: F.lit(1) for c in ("i", "leaf", "seen", "digest", "known", "name", "block", "nodes")})
    got = query(spark, tmp_path, "op12_merkle_manifest", documents=df)
    assert sorted((tuple(r[c] for c in MERKLE_COLUMNS) for r in got), key=str) == manifest(rows)


def test_merkle_empty_and_single(spark, tmp_path):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert query(spark, tmp_path / "none", "op12_merkle_manifest", documents=spark.createDataFrame([], schema)) == []
    rows = [dict(doc_id=3, source="s", lang="l", n_chars=2, text="a\n")]
    got = query(spark, tmp_path / "one", "op12_merkle_manifest", documents=spark.createDataFrame(rows, schema))
    assert [tuple(r[c] for c in MERKLE_COLUMNS) for r in got] == manifest(rows)


# --- substring dedup --------------------------------------------------------

def removed(rows, window):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in words:
        if d is not None:
            for i in range(len(w) - window + 1):
                k = tuple(w[i:i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out, key=str)


def check_rlz(spark, rows, window, gram, extra=()):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for c in extra:
        df = df.withColumn(c, F.lit(0))
    got = rlz.drop_repeats(df, window=window, gram=gram).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got), key=str) == removed(rows, window)
    assert all(sha(r["kept"]) == r["kept_sha256"] for r in got)


@pytest.mark.parametrize("seed, letters", [(1, "ab"), (2, "abc"), (3, "abcdefgh")])
def test_rlz_random(spark, seed, letters):
    """Few words, short windows: phrases overlap, repeat in a document, and match in part."""
    rng = random.Random(seed)
    pool = [" ".join(rng.choice(letters) for _ in range(rng.randint(3, 30))) for _ in range(12)]
    rows = [(rng.randint(0, 60), " ".join(rng.choice(pool) for _ in range(rng.randint(0, 4)))) for _ in range(60)]
    check_rlz(spark, rows, 6, 2)


def test_rlz_passages(spark):
    rng = random.Random(9)

    def prose(n):
        return [f"w{rng.randint(0, 400)}" for _ in range(n)]
    passage = prose(80)
    rows = [(i, " ".join(prose(rng.randint(0, 120)) + passage[rng.randint(0, 40):rng.randint(41, 80)] + prose(30))) for i in range(40)]
    rows += [(100 + i, rows[i][1]) for i in range(10)]                            # copies
    rows += [(200 + i, rows[i][1].replace("w7 ", "v7 ")) for i in range(20)]      # near copies
    check_rlz(spark, rows, 50, 10, extra=("text_key", "spans", "start", "size", "anchor", "content"))


def test_rlz_awkward_rows(spark):
    long = " ".join(f"x{i % 977}" for i in range(60_000))
    same = " ".join(["a"] * 3_000)
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, long), (4, long), (5, "y " + long), (5, "y " + long), (5, long + " z"), (6, same), (7, same + " b"),
            (8, "short"), (8, "short"), (9, " ".join(f"é{i}" for i in range(60))), (10, " ".join("ab") + " " + " ".join(f"é{i}" for i in range(60)))]
    check_rlz(spark, rows, 50, 10)
    assert rlz.drop_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_sql_is_given():
    assert {"op11_conversation_trie", "op12_merkle_manifest", "op13_substring_dedup"} <= set(queries.ORACLE)
