"""Brute-force checks of the training-data operators on small tables and on odd rows."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ragloom.llm import bpe, decontam, hilbert, licenses, linededup, neardup, quality, queries, tokenbin, toxicity, warc
from ragloom.llm.common import SPACE_BYTES, Hasher
from ragloom.session import table
from tests.conftest import SF001

LOW = {c: c + 32 for c in range(65, 91)}
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, word string, items string"

LONG = " ".join(f"w{i % 97}x{i % 89}" for i in range(30_000))
ODD = [None, "", " \n\t ", "one", "a b c d", "the same nine words stand here in one line", LONG,
       "the same nine words stand here in one line", "É́ 日本 😀   x y", "MIT License MIT license",
       "x" * 5000, "idiot moron scum loser " * 30, "# $ % | < > " * 20]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, repeated rows, null keys, extra columns with clashing names."""
    rows = [(i, t, "en", None if i % 3 else "src", None if t is None else len(t), 0.5, "w", "i") for i, t in enumerate(ODD)]
    rows += [rows[5], rows[6], (None, "no id at all here", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF001, "documents")


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


# 1 WARC

def test_warc_round_trip_and_revisits(spark):
    rows = [(0, "http://a/", "x"), (1, "http://b/\r\nc", "x"), (2, None, None), (3, "u", ""), (4, "ü", "é" * 70_000), (None, "n", "x"), (1, "d", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    index = warc.write_archives(pages, archive_bytes=200)
    assert index.select("file").distinct().count() >= 2
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                  for r in warc.read_records(index).collect()), key=str)
    last = {"x": 1, "": 3, "é" * 70_000: 4}
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = i != last[h or ""]
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response",
                     last[h or ""] if again else None))
    assert got == sorted(want, key=str)
    full = {(r["page_id"], r["payload"].decode()) for r in warc.payloads(warc.read_records(index)).collect()}
    assert full == {(i, h or "") for i, _, h in rows}
    one = warc.read_records(index.where("page_id = 4")).collect()
    assert len(one) == 1 and len(one[0]["payload"]) == 140_000
    assert warc.read_records(warc.write_archives(pages.limit(0))).count() == 0


# 2 toxicity

def test_clause_grammar_orders_readings():
    word = [0.0, 0.0]
    insult = toxicity.clause_score([toxicity.OTHER, toxicity.INSULT], [0.0, 4.0])
    assert toxicity.clause_score([toxicity.NEGATION, toxicity.INSULT], [0.0, 4.0]) < insult
    assert toxicity.clause_score([toxicity.REPORT, toxicity.INSULT], [0.0, 4.0]) < insult
    assert toxicity.clause_score([toxicity.TARGET, toxicity.INSULT], [0.0, 4.0]) > insult
    assert toxicity.clause_score([toxicity.OTHER] * 2, word) == 0


def test_toxicity_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    got = queries.op2_toxicity(spark, d).join(table(spark, d, "labels"), "doc_id").where("held_out").collect()
    hit = [r["predicted"] for r in got if r["toxic"]]
    miss = [r["predicted"] for r in got if not r["toxic"]]
    assert len(hit) > 50 and np.mean(hit) >= 0.8 and np.mean(miss) <= 0.03
    assert all(0 <= r["score"] <= 1 for r in got)


def test_toxicity_odd_rows(odd, empty, docs, spark):
    labels = table(spark, SF001, "labels")
    model = toxicity.fit(docs, labels)
    assert odd.withColumn("s", toxicity.score(model, F.col("text"))).where("s is null or s < 0 or s > 1").count() == 0
    out = toxicity.classify(odd, labels.limit(0))
    assert out.count() == odd.count() and out.where("predicted = 1").count() == 0
    assert toxicity.classify(empty, labels).count() == 0


# 3 line dedup

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a):
        new = [i + 1]
        for j, d in enumerate(b):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_banded_distance_and_probes():
    rnd = random.Random(5)
    for _ in range(3000):
        a = "".join(rnd.choices("abc", k=rnd.randint(0, 8)))
        b = "".join(rnd.choices("abc", k=rnd.randint(0, 8)))
        for t in (1, 2, 3):
            assert linededup.within(a, b, t) == (distance(a, b) <= t)
    for t in (1, 2, 3):
        for _ in range(500):
            a = b = "".join(rnd.choices("abcdefgh", k=rnd.randint(20, 30)))
            for _ in range(t):
                i = rnd.randint(0, len(b))
                b = rnd.choice([b[:i] + "x" + b[i:], b[:i] + b[i + 1:], b[:i] + "y" + b[i + 1:]])
            a, b = sorted((a, b), key=len)
            posted = {(len(a), j, a[s:s + n]) for j, (s, n) in enumerate(linededup.segments(len(a), t + 1))}
            assert any((n, j, b[s:s + k]) in posted for n, j, s, k in linededup.probes(len(b), t))
            pa, pb = linededup.parities([a, b])
            assert int(pa ^ pb).bit_count() <= 4 * t


@pytest.mark.parametrize("edits", [1, 2])
def test_line_dedup_brute_force(spark, edits):
    rnd = random.Random(edits)
    base = ["".join(rnd.choices("abcdefgh ", k=rnd.randint(20, 40))).strip() + "zz" * 6 for _ in range(25)] + ["short", "x", "", "  "]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(rnd.randint(0, 6)):
            x = rnd.choice(base)
            if len(x) > 20 and rnd.random() < 0.5:
                k = rnd.randint(0, len(x) - 1)
                x = rnd.choice([x[:k] + x[k + 1:], x[:k] + "Q" + x[k:], x[:k] + "é" + x[k + 1:]])
            lines.append(x + rnd.choice(["", " ", "\t"]))
        rows.append((i, "\n".join(lines)))
    seen, want = [], {}
    for i, t in rows:
        keep = []
        for x in t.split("\n"):
            y = x.strip(linededup.BLANKS)
            near = any(y == z or (min(len(y), len(z)) >= linededup.MIN_CHARS and abs(len(y) - len(z)) <= edits
                                  and distance(y, z) <= edits) for z in seen)
            if not y or not near:
                keep.append(x)
            if y:
                seen.append(y)
        want[i] = "\n".join(keep)
    got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), edits=edits)
    assert {r["doc_id"]: r["text"] for r in got.collect()} == want


def test_line_dedup_odd_rows(odd, empty):
    got = linededup.dedup_lines(odd).collect()
    assert len(got) == odd.count()
    text = {r["doc_id"]: r["text"] for r in got}
    assert text[0] is None and text[1] == "" and text[2] == ODD[2] and text[7] == "" and text[5] == ODD[5]
    assert text[None] == "no id at all here"
    assert linededup.dedup_lines(empty).count() == 0


# 4 decontamination, 8 licenses

def test_decontamination_brute_force(spark, odd, empty):
    items = spark.createDataFrame([(1, "The same NINE words stand here"), (2, None), (3, ""), (4, LONG[:600]), (5, LONG[:600]),
                                   (None, "one")], "item_id long, text string")
    windows = {}
    for i, t in [(r["item_id"], r["text"] or "") for r in items.collect() if r["item_id"] is not None]:
        w = WORD.findall(t.translate(LOW))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add(str(i))
    want = []
    for i, t in texts_of(odd):
        w = WORD.findall(t.translate(LOW))
        hit, names = set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k:k + n])):
                    hit.update(range(k, k + n))
                    names |= found
        want.append((i, len(w), len(hit), ",".join(sorted(names))))
    for most in (10_000, 0):
        got = decontam.contamination(odd, items, max_broadcast=most).collect()
        assert sorted([(r["doc_id"], r["n_words"], r["n_hit"], ",".join(r["items"])) for r in got], key=str) == sorted(want, key=str)
    assert decontam.contamination(empty, items).count() == 0
    assert decontam.contamination(odd, items.limit(0)).where("contaminated").count() == 0
    assert decontam.drop_contaminated(odd, items).columns == odd.columns


def test_licenses_brute_force(odd, empty, docs):
    for df in (odd, docs):
        want = []
        for i, t in texts_of(df):
            w = WORD.findall(t.translate(LOW))
            starts, base = [], set()
            for label, phrase in licenses.PHRASES:
                p = phrase.split()
                for k in range(len(w) - len(p) + 1):
                    if w[k:k + len(p)] == p:
                        starts.append(k)
                        base.add(label)
            labels = set(base)
            for label, text in licenses.TEMPLATES:
                s = set(WORD.findall(text.translate(LOW)))
                for b in range(0, len(w), len(s)):
                    if len(set(w[b:b + 3 * len(s)]) & s) >= licenses.THRESHOLD * len(s):
                        labels.add(label)
            want.append((i, len(w), len(starts), min(starts, default=None), max(starts, default=None),
                         ",".join(sorted(base)), ",".join(sorted(labels))))
        got = [tuple(r)[:7] for r in licenses.scan(df).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert licenses.scan(empty).count() == 0


# 5 BPE, 6 token files

ALPHABET = ["a", "b", " ", "  ", "\n", "\t", "\r\n", " ", "　", "é", "à ", "'s", "'", "<|endoftext|>", ".", "日本", "😀", "\x0b",
            "\x1c", "\x85", "12", "A", "the", "́", "Σ", "İ", " the"]


@pytest.mark.parametrize("slice_chars", [1 << 20, 16])
def test_fragments_equal_whole_text_encoding(slice_chars, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE_CHARS", slice_chars)
    rnd = random.Random(3)
    texts = ["".join(rnd.choices(ALPHABET, k=rnd.randint(0, 30))) for _ in range(4000)] + ["", "x" * 300]
    texts += [" ".join(rnd.choices(["Straße", "ÀÉ,", "word.", "Word;:", "\nNew", "l'été", "x²", "ÿ!", "ñandú?!", "e\u0301", "à", "don't."], k=9))
              for _ in range(2000)]
    path = queries.tokenizer_path(queries.BYTE_BPE)
    whole = bpe.load(path)
    encoder, tokens = bpe.codec(path)
    for t, ids, e in zip(texts, encoder.encode(texts), whole.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids.tolist() == e.ids
        assert bpe.decode_bytes(ids, tokens) == whole.decode(e.ids, skip_special_tokens=False) == t
    words = bpe.load(queries.tokenizer_path(queries.WORD_BPE))
    encoder = queries.word_encoder(queries.tokenizer_path(queries.WORD_BPE))()
    for ids, e in zip(encoder.encode(texts), words.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids.tolist() == e.ids


def test_fragment_table_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_FRAGMENTS", 3)
    t = bpe.load(queries.tokenizer_path(queries.BYTE_BPE))
    f = bpe.Fragments(t, " ")
    texts = [f"w{i} v{i * 7}" for i in range(50)]
    assert [x.tolist() for x in f.encode(texts)] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_bpe_columns(odd, empty):
    path = queries.tokenizer_path(queries.BYTE_BPE)
    both = odd.withColumn("ids", bpe.encode(F.col("text"), path)).withColumn("back", bpe.decode(F.col("ids"), path))
    assert both.where("back <> coalesce(text, '')").count() == 0
    assert empty.select(bpe.round_trip(F.col("text"), path)).count() == 0
    blank = odd.where("text is null").select(bpe.round_trip(F.col("text"), path).alias("r")).select("r.*").first()
    assert blank["n_tokens"] == 0 and blank["ids_sha256"] == blank["decoded_sha256"] == hashlib.sha256(b"").hexdigest()


def test_wavelet_matrix():
    x = np.random.default_rng(2).integers(0, 60, 3000).astype(np.uint16)
    w = tokenbin.WaveletMatrix.build(x, 16)
    assert (w.decode() == x).all() and [w.access(i) for i in range(0, 3000, 7)] == x[::7].tolist()
    for token in (0, 7, 59, 61, 70_000):
        at = np.flatnonzero(x == token).tolist()
        assert w.count(token) == len(at) and w.occurrences(token) == at
        assert w.count(token, 100, 900) == sum(100 <= i < 900 for i in at)
    assert tokenbin.WaveletMatrix.build(x[:0], 16).decode().size == 0


def test_token_files(docs, odd, empty):
    make = queries.word_encoder(queries.tokenizer_path(queries.WORD_BPE))
    whole = bpe.load(queries.tokenizer_path(queries.WORD_BPE))
    manifest = tokenbin.write_tokens(docs, make, 1, queries.WORD_BPE_SIZE, shard_tokens=20_000)
    assert manifest.count() > 3
    at, want = 0, {}
    for i, t in sorted(texts_of(docs)):
        ids = np.array([*whole.encode(t, add_special_tokens=False).ids, 1], "<u4")
        want[i] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    got = tokenbin.read_tokens(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids"))
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want
    back = tokenbin.read_tokens(tokenbin.write_tokens(odd, make, 1, queries.WORD_BPE_SIZE, shard_tokens=100))
    assert back.count() == odd.count() and back.where("n_tokens = 1").count() == 3
    assert tokenbin.read_tokens(tokenbin.write_tokens(empty, make, 1, queries.WORD_BPE_SIZE)).count() == 0


# 7 sharding

def test_hilbert_neighbours(spark):
    cells = [r["cell"] for r in hilbert.curve(3, spark, 3).orderBy("h").collect()]
    points = [(c >> 6, c >> 3 & 7, c & 7) for c in cells]
    assert sorted(cells) == list(range(512))
    assert all(sum(abs(a - b) for a, b in zip(p, q, strict=True)) == 1 for p, q in zip(points, points[1:], strict=False))


@pytest.mark.parametrize("group_rows", [20_000, 3])
def test_sharding_law(spark, docs, odd, empty, group_rows, monkeypatch):
    monkeypatch.setattr(hilbert, "GROUP_ROWS", group_rows)
    for df in (docs.select("doc_id", "lang", "source", "n_chars"), odd, spark.range(5).selectExpr(
            "id doc_id", "'en' lang", "'s' source", "1 n_chars")):
        rows = hilbert.assign(df, 24, queries.SHARD_DIMS, "doc_id").collect()
        assert len(rows) == df.count()
        slots = {s: sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(24)}
        sizes = [len(x) for x in slots.values()]
        assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
        assert all(x == list(range(len(x))) for x in slots.values())
    assert hilbert.assign(empty, 24, queries.SHARD_DIMS, "doc_id").count() == 0


# 9 near duplicates

def brute_components(rows, percent):
    sets = []
    for _, t in rows:
        w = SPACE_WORD.findall(t.translate(LOW))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (i, _), x in zip(rows, label, strict=True):
        if i is not None:
            least[x] = min(least.get(x, i), i)
    return [(i, len(s), least.get(x)) for (i, _), s, x in zip(rows, sets, label, strict=True)]


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_brute_force(spark, docs, odd, percent):
    rnd = random.Random(percent)
    vocabulary = [f"w{i}" for i in range(500)]
    base = rnd.choices(vocabulary, k=80)
    rows = [(1000 + i, " ".join(rnd.choice(vocabulary) if rnd.random() < i % 7 / 100 else w for w in base)) for i in range(60)]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    for df in (docs.select("doc_id", "text"), made.union(odd.select("doc_id", "text").where("doc_id is not null"))):
        got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(df, percent).collect()]
        assert sorted(got) == sorted(brute_components(texts_of(df), percent))


def test_near_duplicate_pieces_meet(spark, monkeypatch):
    """A block cut into many pieces gives the same groups."""
    base = [f"v{i}" for i in range(60)]
    rows = [(i, " ".join([*base, f"t{i % 5}", f"u{i}"])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(neardup, "PIECE_SET_BYTES", 2000)
    assert {r["component_id"] for r in neardup.near_duplicates(df, 85).collect()} == {0}


def test_near_duplicates_odd_rows(odd, empty):
    got = neardup.drop_near_duplicates(odd)
    assert got.columns == odd.columns
    kept = [r["doc_id"] for r in got.collect()]
    assert sorted(x for x in kept if x is not None) == [i for i in range(len(ODD)) if i != 7] and kept.count(None) == 1
    assert neardup.near_duplicates(empty).count() == 0 and neardup.drop_near_duplicates(empty).count() == 0


# 10 quality

def brute_signals(t):
    w = SPACE_WORD.findall(t)
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    many = {g for g in grams if grams.count(g) > 1} if len(grams) < 3000 else {g for g, n in __import__("collections").Counter(grams).items() if n > 1}
    covered = {j for i, g in enumerate(grams) if g in many for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if SPACE_WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def test_quality_brute_force(docs, odd, empty):
    for df in (docs, odd):
        got = [(r["doc_id"], *[r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                r["base_failed"]) for r in quality.judge(df, ["doc_id"]).collect()]
        want = []
        for i, t in texts_of(df):
            s = brute_signals(t)
            want.append((i, *s, s[0] < 20 or 100 * s[4] > 30 * s[0]))
        assert sorted(got, key=str) == sorted(want, key=str)
    assert quality.judge(empty, ["doc_id"]).count() == 0 and quality.filter_documents(empty).count() == 0


def test_host_verdicts(spark):
    rows = [("good", i % 20 == 0) for i in range(400)] + [("bad", i % 20 != 0) for i in range(400)] + [("tiny", True)]
    got = {r["host"]: r for r in quality.host_verdicts(spark.createDataFrame(rows, "host string, failed boolean")).collect()}
    assert got["bad"]["refused"] and not got["good"]["refused"]
    assert got["tiny"]["shrunk_rate"] < 1
    text = " ".join(f"w{i}" for i in range(40))
    made = spark.createDataFrame([(i, "no", "bad") for i in range(50)] + [(99, text, "bad"), (100, text, "good"), (101, text, None)],
                                 "doc_id long, text string, source string")
    assert sorted(r["doc_id"] for r in quality.filter_documents(made).collect()) == [100, 101]
    judged = quality.judge(made, ["doc_id"]).where("kept").collect()
    assert sorted(r["doc_id"] for r in judged) == [100, 101]


def test_word_longer_than_a_piece(monkeypatch):
    from ragloom.llm import common
    texts = [b"aa " + b"x" * 90 + b" bb", b"", b"aa bb aa"]
    plain, _ = Hasher(SPACE_BYTES, True).words(texts, (2,))
    monkeypatch.setattr(common, "PIECE_BYTES", 16)
    cut, _ = Hasher(SPACE_BYTES, True).words(texts, (2,))
    assert (plain.hash == cut.hash).all() and plain.hash[0] == plain.hash[3] == plain.hash[5] != plain.hash[1]
