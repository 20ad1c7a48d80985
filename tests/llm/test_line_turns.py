"""Line deduplication in bounded disk and memory: postings in turns, batched
comparison, one cut of a text."""

import os
import random
import time

import numpy as np

import corpus_pipeline
from ragloom.llm import linenear, neardup
from ragloom.llm.common import SHUFFLE_CLEANUP, keep


def edited(rnd, x, k):
    for _ in range(k):
        i, c = rnd.randint(0, max(0, len(x) - 1)), rnd.choice("abc é😀")
        x = rnd.choice([x[:i] + c + x[i:], x[:i] + x[i + 1:], x[:i] + c + x[i + 1:]])
    return x


def test_batched_distance():
    rnd, a, b = random.Random(4), [], []
    for n in [*range(1, 50), 79, 80, 119, 380, 639, 640, 641, 1279, 1280, 1920, 2559, 2560, 3000]:
        for _ in range(6):
            x, k = "".join(rnd.choices(rnd.choice(["ab", "abc é", "abcdefghijk"]), k=n)), max(1, n // 20)
            y = edited(rnd, x, rnd.choice([0, 1, k // 2, k, k, k + 1, k + 5]))
            a.append("q" * rnd.choice([0, 0, 0, k]) + x)
            b.append(y)
    want = [linenear._distance_within(x, y, max(len(x), len(y)) // 20) for x, y in zip(a, b, strict=True)]
    assert linenear.near_each(a, b).tolist() == want and 0 < sum(want) < len(want)
    assert linenear.near_each([], []).tolist() == []


def test_turns_post_everything_once_and_evenly(spark):
    rnd = random.Random(8)
    text = "\n".join("".join(rnd.choices("abcdefgh ", k=200)) for _ in range(300))
    texts = spark.createDataFrame([(text,)], "text string")
    found = []
    for turn, turns in ((0, 1), (0, 2), (1, 2)):
        rows = linenear._postings(texts, 4, 34, 20, " ", turn, turns).where("packed is not null").collect()
        found.append(np.sort(np.concatenate([linenear._unpack(r["base"], r["packed"])[0] for r in rows])))
    assert (np.concatenate(found[1:]) == found[0]).all()
    assert abs(len(found[1]) - len(found[2])) < 0.1 * len(found[0])


def test_kept_tables_leave_no_shuffle_files(spark):
    def files():
        top = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in top for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}

    before, setting = files(), spark.conf.get(SHUFFLE_CLEANUP, None)
    few = keep(spark.range(1000).repartition(3, "id"), "few")
    end = time.time() + 10
    while not files() <= before and time.time() < end:  # other executors are told, not waited for
        time.sleep(0.1)
    assert files() <= before and spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    assert few.count() == 1000


def test_line_dedup_stage_cuts_texts_once(spark):
    docs = spark.createDataFrame([(1, "one line that is long enough to count\nb", "en", "s", 9), (2, "b", "en", "s", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.line_dedup(spark, docs, "")
    assert [tuple(r) for r in out.collect()] == [(1, "one line that is long enough to count\nb", "en", "s", 39)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_pieces_do_not_change_shingles(monkeypatch):
    texts = [b"", b"one two", " ".join(map(str, range(900))).encode(), b"a b c d e f g"] * 3
    whole = [s.tolist() for s in neardup.shingle_sets(texts)]
    monkeypatch.setattr(neardup, "HASHED_BYTES", 10)
    assert [s.tolist() for s in neardup.shingle_sets(texts)] == whole


def test_a_common_phrase_makes_no_pairs(spark):
    """Lines that share a q-gram, but no window around it, do not meet, however many they are."""
    rnd, letters = random.Random(5), "abcdefghijklmnop "
    lo, hi, q, w = next(x for x in linenear.schemes() if x[0] <= 200 < x[1])

    def lines(phrase):
        return ["".join(rnd.choices(letters, k=100)) + phrase + "".join(rnd.choices(letters, k=100 - q)) for _ in range(300)]

    phrases = ["".join(rnd.choices(letters, k=q)) for _ in range(20)]
    best = max((lines(p) for p in phrases), key=lambda x: int((linenear.grams(x, q, w)[2] == 100).sum()))
    n = int((linenear.grams(best, q, w)[2] == 100).sum())
    assert n > 200  # lines that post the phrase, at one place
    texts = spark.createDataFrame([(x,) for x in best], "text string").repartition(3)
    groups = keep(linenear._groups(linenear._postings(texts, 4, 34, 20, "", 0, 1), 2), "groups")
    met = groups.where("a is not null").count() + linenear._rest(groups, np.empty(0, np.int64)).count()
    assert met < n


def test_contexts_agree_along_common_windows():
    """Two lines that share one window, with any characters around it, meet in their class."""
    rnd = random.Random(6)
    for k, (_, hi, q, w) in enumerate(linenear.schemes()):
        for _ in range(200):
            run, n = "".join(rnd.choices("abcd ", k=q + w - 1)), min(hi, 500) - 1
            a, b = ("".join(rnd.choices("abcd ", k=x)) + run + "".join(rnd.choices("abcd ", k=n - x - len(run)))
                    for x in (rnd.choice([0, 3, n - len(run)]) if n > len(run) + 3 else 0 for _ in range(2)))
            h, own, _, around = linenear._least_grams([a, b], q, w)
            one, two = ([(x, y) for x, y, o in zip(h, around, own, strict=True) if o == side] for side in (0, 1))
            kind = np.array([k])
            assert any(x == y and linenear._agree(kind, np.array([c]), np.array([d]))[0] for x, c in one for y, d in two)
            halves = []
            for some in (one, two):
                slot = np.array([x for x, _ in some]) >> np.uint64(30) << np.uint64(3) | np.uint64(k)
                rest = np.zeros(len(slot), np.int64)
                halves.append(set(linenear._sides(slot, rest, rest, rest, np.array([c for _, c in some]))[0].tolist()))
            assert halves[0] & halves[1]


def test_lines_are_numbered_by_rank(spark):
    text = "\n".join("line number %d of some text" % i for i in range(50))
    texts = spark.createDataFrame([(text, 9), (text + "a", 2)], "text string, rank int").repartition(2, "rank")
    rows = linenear._postings(texts, 2, 34, 20, " ", 0, 1).where("keys is not null").collect()
    assert {r["base"] >> 47 for r in rows} <= {2, 9} and len(rows) >= 1
